"""Join helpers with an explicit, checked broadcast decision.

A side is broadcast only after its row count has been measured and found
under ``max_rows``; otherwise the join stays a shuffle join (sort-merge,
with AQE's skew-join splitting hot keys).  The measured side is
checkpointed first, so the count and the join read the same bytes and the
small table survives executor loss without recomputing its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import scratch_path

# Rows of a key-only table (ids / hashes) we are willing to ship to every executor.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Rows of a table carrying strings or arrays (e.g. encoded pre-tokens).
WIDE_MAX_BROADCAST_ROWS = 200_000


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint dir.

    The frame is persisted for the duration of the checkpoint: the reliable
    checkpoint writes its files in a second job, which would otherwise
    recompute the whole plan.
    """
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table as Parquet below the shared checkpoint dir and read it back.

    Cuts lineage like ``materialize``; readers take only the columns they
    use, and the optimizer knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> tuple[DataFrame, int]:
    """Materialize a small-ish derived table and return it with its row count."""
    m = materialize(df)
    return m, m.count()


def checked_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 small_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if measured small."""
    if small_rows is None:
        small, small_rows = sized(small)
    if small_rows <= max_rows and how in ("inner", "left", "left_outer", "left_semi",
                                          "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        small = F.broadcast(small)
    return big.join(small, on, how)


def drop_keys(big: DataFrame, keys: DataFrame, on, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
              keys_rows: int | None = None) -> DataFrame:
    """Rows of ``big`` whose key does not appear in ``keys`` (left anti join)."""
    return checked_join(big, keys, on, "left_anti", max_rows, keys_rows)
