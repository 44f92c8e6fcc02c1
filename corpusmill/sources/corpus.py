"""Readers and writers for corpora, splits, instruction records and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

ALPACA_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables (``{sf_dir}/{name}.parquet``), read anew by every query."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame, cores: int | None = None) -> DataFrame:
    """Give a scan that only a few tasks would work on one partition per core.

    A parquet file is cut into splits by bytes, but a split without the middle of a row group has no
    rows: a table that is one row group is read by one task, however many splits it has.
    So the rows of each split are counted, which reads footers only; scans
    of twice as many splits as cores are large, and are taken as they are without a look.
    The exchange carries the columns that the query uses.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("split")).count().collect()]
    # The slowest task has more than twice the rows that an even deal gives.
    return df.repartition(cores) if rows and max(rows) > 2 * -(-sum(rows) // cores) else df


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", text_col: str = "text",
                schema: T.StructType | None = None) -> DataFrame:
    """Read a corpus directory (parquet, or Arrow IPC through our data source)."""
    if fmt == "parquet":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = spread(reader.parquet(path))
    elif fmt in ("arrow", "arrow_ipc", "ipc"):
        from corpusmill.sources.arrow_ipc import register
        register(spark)
        reader = spark.read.format("arrow_ipc")
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(path)
    else:
        raise ValueError(f"unsupported corpus format: {fmt}")
    return with_text(df, text_col, keep_other=True)


def with_text(df: DataFrame, text_col: str = "text", keep_other: bool = False) -> DataFrame:
    """Expose the chosen text column as ``text``; fail clearly if it is absent."""
    if text_col not in df.columns:
        raise ValueError(f"text column {text_col!r} not found; columns are {df.columns}")
    if text_col == "text":
        return df if keep_other else df.select(*[c for c in df.columns if c in ("doc_id", "text")])
    others = [c for c in df.columns if c not in (text_col, "text")] if keep_other else \
        [c for c in df.columns if c == "doc_id"]
    return df.select(*others, F.col(text_col).alias("text"))


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """Write one table partitioned by split (``path/split=train``, ``path/split=validation``).

    No shuffle: every task writes its rows of each split (sorted by split, so
    one open file per task at a time) - a repartition on the split column
    would funnel the whole corpus through two tasks.
    """
    (df.sortWithinPartitions(split_col, "doc_id")
       .write.mode(mode).partitionBy(split_col).parquet(path))


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)   # partition pruning


def read_alpaca(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Alpaca-style instruction records: JSON lines (splittable), or files that hold an array or spread a record over lines.

    Unless ``multi_line`` says which, the first line that is not blank decides: a
    whole object on it means JSON lines.  Anything that is not JSON is an error, never a row of nulls.
    """
    if multi_line is None:
        first = spark.read.text(path).where(F.trim("value") != "").select(
            F.trim("value").startswith("{"), F.from_json("value", "map<string,string>").isNotNull()).limit(1).collect()
        multi_line = bool(first) and not all(first[0])
    return (spark.read.schema(ALPACA_SCHEMA).option("multiLine", str(multi_line).lower())
            .option("mode", "FAILFAST").json(path))


def write_alpaca(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("instruction", "input", "output").write.mode(mode).json(path)


def write_batches(df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> None:
    """Collated batches, range-partitioned by batch_id so a trainer reads batches in order.

    ``num_files`` defaults to ``spark.sql.shuffle.partitions`` (size it to the
    output: token arrays are ~4 bytes per token).
    """
    spark = df.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, "batch_id", "pos")
       .sortWithinPartitions("batch_id", "pos")
       .write.mode(mode).parquet(path))
