"""corpusmill: text-corpus preparation for language-model training, on Spark.

Cleaning, deduplication, sampling/splitting, byte-level BPE training,
encoding, overlapping windows, batching and instruction-data preparation,
each expressed as DataFrame operators (plus Structured Streaming forms).
"""

from corpusmill.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
