"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import prepare, scratch_path

# A word of the contracts: a run of anything but space and the five ASCII controls 9 to 13.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables, read by Spark only (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a derived table to the shared scratch folder and read it back.

    Cuts lineage: what follows survives a lost executor without redoing what
    came before, and sizes of the table are known to the optimizer.
    """
    spark = df.sparkSession
    prepare(spark)
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int):
    """Jobs started inside hand at most about ``limit`` bytes at a time to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def text_bytes(column: pa.Array) -> list:
    """UTF-8 bytes of a string column (None for null)."""
    return column.cast(pa.binary()).to_pylist()


def pieces(batches, column: str, limit: int = 8 << 20):
    """Cut Arrow batches into slices of at most ``limit`` bytes of one column (one row at least)."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.cumsum(lengths)
        i = 0
        while i < n:
            base = at[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(at, base + limit, "right")))
            yield b.slice(i, j - i)
            i = j


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
        taken.add(n.lower())
    return out


def null_safe(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Add a never-null key pair for an equi-join that treats null as a value."""
    return df.withColumns({f"{prefix}_k": F.coalesce(F.col(column).cast("string"), F.lit("")),
                           f"{prefix}_n": F.col(column).isNull()})


def matching(big: DataFrame, keys: DataFrame, on, how: str, max_rows: int = 1_000_000) -> DataFrame:
    """Semi or anti join with a written table of keys, broadcast if it has at most ``max_rows`` rows, else shuffled."""
    small = keys.limit(max_rows + 1).count() <= max_rows
    return big.join(F.broadcast(keys) if small else keys, on, how)


def sum_vectors(df: DataFrame, key: str, vec: str, size: int, fan_in: int = 64) -> DataFrame:
    """Element-wise sum of little-endian float64 blobs per key, as (key, vec).

    A tree of grouped sums: no task adds more than about ``fan_in`` times the
    square root of the number of blobs, whatever the number of partitions.
    """
    schema = df.select(key, vec).schema

    def add(batches):
        sums: dict = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(v, np.float64)
                if k in sums:
                    sums[k] += x
                else:
                    sums[k] = x.copy()
        if sums:
            ks = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, type=arrow_type(schema[key].dataType)),
                 pa.array([sums[k].tobytes() for k in ks], type=pa.binary())], names=[key, vec])

    level = df.select(key, vec)
    first = (level.withColumn("_shard_", F.pmod(F.monotonically_increasing_id(), F.lit(fan_in)))
                  .repartition("_shard_", key).select(key, vec).mapInArrow(add, schema))
    return first.repartition(key).mapInArrow(add, schema)


def arrow_type(data_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(data_type)
