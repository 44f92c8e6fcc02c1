"""The corpus pipeline: quality rules, SimHash near-dedup, decontamination, PII, mixing.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir) and
returns what is left of ``docs``; its result is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of
``documents``; the last returns the mix, a document as often as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or their host's verdict reject go."""
    from corpusmill.llm.quality import quality_filter
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    from corpusmill.llm.simhash import keep_one
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, question and answer, go."""
    from corpusmill.llm.common import table
    from corpusmill.llm.decontam import decontaminate
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are taken out of the texts; every document stays."""
    from corpusmill.llm.pii import sanitise
    return sanitise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix of sources takes it."""
    from corpusmill.llm.mixing import mixed_documents
    return mixed_documents(docs)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination),
          ("pii", pii), ("mixing", mixing)]

# Fingerprints are XXH64 hashes and rates the solution of an iteration: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    from corpusmill.llm.common import saved, table
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
