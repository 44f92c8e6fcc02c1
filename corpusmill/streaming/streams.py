"""Structured Streaming forms of the corpus operators, for document files that keep arriving.

* ``stream_corpus`` (A5) - file source with an explicit schema.
* ``stream_clean`` (G1) - the stateless row rules; each micro-batch gives the
  same rows the batch operator gives for those files.
* ``stream_windows`` (G2) - encode + windows per micro-batch (``foreachBatch``),
  written under ``batch_id=<id>``, a folder that appears whole: a replayed micro-batch finds
  it and writes nothing, so a stream that reads the folders sees every window once.
* ``stream_dedup`` (G3) - first arrival wins across micro-batches and restarts;
  inside a micro-batch the smallest doc_id wins.  Seen keys are kept in a merged table by key prefix and the keys of
  the batches since; every ``COMPACT`` batches these are merged.  A replay of batch b reads only
  keys of batches < b and overwrites its own partition, so it is idempotent.
* ``stream_sample_count`` (G4) - running documents / tokens / samples per
  language, a streaming aggregation in complete mode.
* ``stream_window_count`` (G4) - the same over the output of ``stream_windows``, under whatever tokenizer
  that uses: a second query, chained by the folder.

Checkpoints and outputs belong in the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions import text as tx
from corpusmill.operators import clean
from corpusmill.operators import windows as W
from corpusmill.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, materialize
from corpusmill.sources.corpus import DOCUMENTS_SCHEMA


def stream_corpus(spark: SparkSession, path: str, schema=DOCUMENTS_SCHEMA, max_files_per_trigger: int | None = None,
                  glob: str | None = None) -> DataFrame:
    """A5: arriving parquet document files as a streaming DataFrame.

    ``path``: the folder in which they arrive, or a single file: a stream
    reads folders only, so that file is picked by its name from its own.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(p):
        path, glob = p.getParent().toString(), p.getName()
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def clean_rows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The stateless cleaning chain shared by batch and stream."""
    out = clean.strip_control(df, text_col)
    out = clean.normalize_text(out, text_col)
    out = clean.license_strip(out, text_col=text_col)
    out = clean.pii_redact(out, text_col=text_col)
    out = clean.secret_redact(out, text_col=text_col)
    out = clean.length_filter(out, text_col=text_col)
    out = clean.annotate_quality(out, text_col).where(F.col("keep"))
    return out.select("doc_id", text_col, "lang", "source")


def _start(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True,
           mode: str = "append") -> StreamingQuery:
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode(mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(out)


def stream_clean(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                 spread_partitions: int | None = None) -> StreamingQuery:
    """G1: cleaned documents appended to a parquet sink (exactly-once via the file sink log).

    ``spread_partitions`` round-robins each micro-batch over that many tasks
    first - for arriving files that are few and large (one task per file
    would leave cores idle on CPU-bound cleaning).
    """
    src = stream.repartition(spread_partitions) if spread_partitions else stream
    return _start(clean_rows(src), out, checkpoint, available_now=available_now)


COMPACT = 16                 # batches after which the seen keys are merged


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _overwrite_batch(df: DataFrame, path: str, batch_id: int, *by: str) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id", *by).parquet(path))


def stream_windows(stream: DataFrame, tokenizer, out: str, checkpoint: str,
                   max_seq_length: int = W.MAX_SEQ_LENGTH, overlap_size: int = W.OVERLAP,
                   available_now: bool = True) -> StreamingQuery:
    """Clean + encode + windows per micro-batch with a fixed (already trained) tokenizer.

    Writes (doc_id, lang, window_ix, input_ids, n_tokens).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if _exists(batch.sparkSession, f"{out}/batch_id={batch_id}"):
            return                               # the folder of a batch is put in place by one rename
        enc = tokenizer.encode_columns(clean_rows(batch).select("doc_id", "lang", "text"), {"text": "input_ids"})
        win = W.windows(enc.withColumn("n_tokens", F.size("input_ids").cast("bigint")), max_seq_length, overlap_size)
        _overwrite_batch(win, out, batch_id)
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _numbers(spark: SparkSession, path: str, name: str, whole: bool = False) -> list[int]:
    """The n of the folders ``name=n`` below ``path``; with ``whole`` of those whose write was committed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(x.split("=")[1]) for x in found if x.startswith(f"{name}=") and
                  (not whole or _exists(spark, f"{path}/{x}/_SUCCESS")))


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


KEYS = "k string, doc_id bigint"


def _seen_before(spark: SparkSession, seen: str, batch_id: int) -> tuple[DataFrame, int]:
    """(k, doc_id) that batches before ``batch_id`` have seen, and the last batch that the merged table holds (-1: none)."""
    base = max((n for n in _numbers(spark, f"{seen}/merged", "upto", whole=True) if n < batch_id), default=-1)
    late = [n for n in _numbers(spark, f"{seen}/batches", "batch_id") if base < n < batch_id]
    rows = spark.createDataFrame([], KEYS)
    if base >= 0:
        rows = rows.unionByName(spark.read.schema(f"{KEYS}, kp string").parquet(f"{seen}/merged/upto={base}"), allowMissingColumns=True)
    else:
        rows = rows.withColumn("kp", F.lit(None).cast("string"))
    if late:
        files = spark.read.schema(KEYS).parquet(*[f"{seen}/batches/batch_id={n}" for n in late])
        rows = rows.unionByName(files.withColumn("kp", F.substring("k", 1, 2)))
    return rows, base


def merge_seen(spark: SparkSession, seen: str, batch_id: int) -> None:
    """Merge the keys of all batches up to ``batch_id`` into one table, a file per key prefix, and drop what it replaces.

    The table before stays until the next merge, so a replay of this batch still finds what came before it.
    """
    rows, base = _seen_before(spark, seen, batch_id + 1)
    (rows.withColumn("kp", F.substring("k", 1, 2)).repartition("kp").sortWithinPartitions("kp", "k")
         .write.mode("overwrite").partitionBy("kp").parquet(f"{seen}/merged/upto={batch_id}"))
    for n in _numbers(spark, f"{seen}/merged", "upto"):
        if n < base:
            _remove(spark, f"{seen}/merged/upto={n}")
    for n in _numbers(spark, f"{seen}/batches", "batch_id"):
        if n <= base:
            _remove(spark, f"{seen}/batches/batch_id={n}")


def dedup_batch(batch: DataFrame, batch_id: int, seen: str, out: str,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, compact: int = COMPACT) -> None:
    """G3 body for one micro-batch (public so a replay can be driven directly in tests).

    The seen keys are at most 256 files per merged table (two of them) and the files of
    ``2 * compact`` batches, however long the stream has run.
    """
    spark = batch.sparkSession
    keyed = batch.withColumn("k", tx.dedup_key("text"))
    first = keyed.groupBy("k").agg(F.min("doc_id").alias("doc_id"))
    # An unreadable table fails the batch; it is not a first batch.
    prior, _ = _seen_before(spark, seen, batch_id)
    prefixes = [r[0] for r in first.select(F.substring("k", 1, 2)).distinct().collect()]      # 256 at most
    prior = prior.where(F.col("kp").isin(prefixes)).select("k")
    # The seen-key table grows with the stream: broadcast only when measured small.
    n_prior = prior.count()
    if n_prior:
        right = F.broadcast(prior) if n_prior <= max_broadcast_rows else prior
        first = first.join(right, "k", "left_anti")
    first = materialize(first)
    winners = keyed.join(first.select("doc_id", "k"), ["doc_id", "k"], "left_semi").drop("k")
    _overwrite_batch(winners, out, batch_id)
    _overwrite_batch(first.select("k", "doc_id").sort("k"), f"{seen}/batches", batch_id)
    if batch_id % compact == compact - 1:
        merge_seen(spark, seen, batch_id)


def stream_dedup(stream: DataFrame, seen: str, out: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Exact-duplicate removal across micro-batches and restarts."""
    w = stream.writeStream.option("checkpointLocation", checkpoint) \
              .foreachBatch(lambda b, i: dedup_batch(b, i, seen, out))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def sample_count_agg(df: DataFrame, max_seq_length: int = W.MAX_SEQ_LENGTH, overlap_size: int = W.OVERLAP) -> DataFrame:
    """Per-language documents / tokens / samples under the word-level encoder (one id per word)."""
    n = tx.word_count("text")
    return (df.groupBy("lang")
              .agg(F.count(F.lit(1)).cast("bigint").alias("documents"), F.sum(n).cast("bigint").alias("tokens"),
                   F.sum(W.window_count(n, max_seq_length, overlap_size)).cast("bigint").alias("samples")))


def stream_sample_count(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Running counts per language; every micro-batch rewrites the complete result."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)
    w = sample_count_agg(stream).writeStream.outputMode("complete") \
        .option("checkpointLocation", checkpoint).foreachBatch(run)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def window_count_agg(windows: DataFrame, overlap_size: int = W.OVERLAP) -> DataFrame:
    """Per-language documents / tokens / samples of written windows; tokens that windows repeat count once."""
    again = F.when(F.col("window_ix") > 0, F.least(F.col("n_tokens"), F.lit(overlap_size))).otherwise(0)
    return (windows.groupBy("lang")
                   .agg(F.sum((F.col("window_ix") == 0).cast("bigint")).alias("documents"),
                        F.sum(F.col("n_tokens") - again).cast("bigint").alias("tokens"),
                        F.count(F.lit(1)).cast("bigint").alias("samples")))


def stream_window_count(spark: SparkSession, windows_path: str, out: str, checkpoint: str, overlap_size: int = W.OVERLAP,
                        available_now: bool = True) -> StreamingQuery:
    """G4 over G2: running counts per language from the folders that ``stream_windows`` writes, with its tokenizer's tokens."""
    schema = "lang string, window_ix int, n_tokens bigint, batch_id bigint"
    stream = spark.readStream.schema(schema).parquet(windows_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)
    w = window_count_agg(stream, overlap_size).writeStream.outputMode("complete") \
        .option("checkpointLocation", checkpoint).foreachBatch(run)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
