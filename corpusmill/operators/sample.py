"""Reproducible sampling and train/validation splitting.

Every decision is a function of ``bucket(id, seed)`` (an md5 of
``"{seed}:{id}"``), never of ``rand()``: results are identical under any
partitioning, on retries after executor loss, and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.joins import materialize
from corpusmill.operators.prefix import prefix_cutoff


def _share(bucket, fraction: float, least: int = 1000):
    """bucket % m < m * fraction, m the least power of ten from ``least`` on that holds the fraction (to nine digits)."""
    m = least
    while m < 10**9 and abs(fraction * m - round(fraction * m)) > 1e-9:
        m *= 10
    return F.pmod(bucket, F.lit(m)) < int(round(fraction * m))


def hash_sample(df: DataFrame, fraction: float = 0.10, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Keep rows with bucket(id, seed) % 1000 < 1000 * fraction (finer for finer fractions)."""
    return df.where(_share(tx.hash_bucket(id_col, seed), fraction))


def split(df: DataFrame, val_fraction: float = 0.01, seed: int = 43, id_col: str = "doc_id",
          split_col: str = "split") -> DataFrame:
    """Disjoint, complete train/validation assignment by a second seed."""
    is_val = _share(tx.hash_bucket(id_col, seed), val_fraction, 10_000)
    return df.withColumn(split_col, F.when(is_val, "validation").otherwise("train"))


def budget_sample(df: DataFrame, max_bytes: int, seed: int = 42, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Documents in (bucket, id) order while the running UTF-8 byte total stays <= max_bytes."""
    keyed = df.withColumn("_bk_", tx.hash_bucket(id_col, seed)) \
              .withColumn("_bytes_", F.octet_length(text_col).cast("bigint"))
    return prefix_cutoff(keyed, [], "_bk_", id_col, "_bytes_", max_bytes).drop("_bk_", "_bytes_")


def stratified_sample(df: DataFrame, by=("lang", "source"), fraction: float = 0.10, seed: int = 42,
                      id_col: str = "doc_id") -> DataFrame:
    """C4: ceil(fraction * n) rows of every stratum, first in (bucket, id) order."""
    keyed = df.withColumn("_bk_", tx.hash_bucket(id_col, seed))

    def budget(n, _w):
        return F.ceil(n.cast("double") * F.lit(float(fraction)) - F.lit(1e-9))
    return prefix_cutoff(keyed, list(by), "_bk_", id_col, None, budget).drop("_bk_")


def cluster_split(df: DataFrame, components: DataFrame, val_fraction: float = 0.01, seed: int = 43,
                  id_col: str = "doc_id", split_col: str = "split") -> DataFrame:
    """Split on the duplicate-component id so all copies land on one side.

    ``components`` is (doc_id, component) for every document.
    """
    withc = df.join(components.select(id_col, "component"), id_col)
    is_val = _share(tx.hash_bucket("component", seed), val_fraction, 10_000)
    return withc.withColumn(split_col, F.when(is_val, "validation").otherwise("train"))


def split_report(df: DataFrame, components: DataFrame | None = None, id_col: str = "doc_id",
                 text_col: str = "text", split_col: str = "split") -> DataFrame:
    """rows/bytes per split plus duplicates that cross splits.

    cross_exact = documents of the split whose dedup key also occurs in the
    other split; cross_near = documents whose duplicate component (exact or
    near) also occurs in the other split.  Only (key, split) and
    (component, split) are shuffled.
    """
    base = df.select(id_col, split_col, F.octet_length(text_col).cast("bigint").alias("b"),
                     tx.dedup_key(text_col).alias("k"))
    # Written tables on both sides: AQE then splits a hot key, which it cannot beside an aggregate on that key.
    base = materialize(base)
    ksplits = materialize(base.groupBy("k").agg(F.countDistinct(split_col).alias("ns")))
    out = base.join(ksplits, "k")
    if components is not None:
        c = out.join(components.select(id_col, "component"), id_col, "left") \
               .withColumn("component", F.coalesce("component", id_col))
        c = materialize(c)
        csplits = materialize(c.groupBy("component").agg(F.countDistinct(split_col).alias("nc")))
        out = c.join(csplits, "component")
    else:
        out = out.withColumn("nc", F.col("ns"))
    return (out.groupBy(split_col)
               .agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("b").cast("bigint").alias("bytes"),
                    F.sum(F.when(F.col("ns") > 1, 1).otherwise(0)).cast("bigint").alias("cross_exact"),
                    F.sum(F.when(F.col("nc") > 1, 1).otherwise(0)).cast("bigint").alias("cross_near")))


def val_subset(batches: DataFrame, max_batches: int = 5000) -> DataFrame:
    """The first ``max_batches`` validation batches."""
    return batches.where(F.col("batch_id") < max_batches)
