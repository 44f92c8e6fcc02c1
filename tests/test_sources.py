import os

from corpusmill.sources import corpus
from corpusmill.sources.arrow_ipc import register


def test_arrow_roundtrip(spark, tmp_dir):
    register(spark)
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = os.path.join(tmp_dir, "arrow")
    d.repartition(3).write.format("arrow_ipc").mode("overwrite").save(path)
    back = corpus.read_corpus(spark, path, fmt="arrow")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, d.collect()))
    d.repartition(2).write.format("arrow_ipc").mode("overwrite").save(path)   # overwrite replaces files
    assert len([f for f in os.listdir(path) if f.endswith(".arrow")]) == 2


def test_with_text_missing_column(spark):
    import pytest
    d = spark.createDataFrame([(1, "x")], "doc_id bigint, body string")
    with pytest.raises(ValueError):
        corpus.with_text(d, "text")
    assert corpus.with_text(d, "body").columns == ["doc_id", "text"]


def test_splits_roundtrip(spark, tmp_dir):
    from corpusmill.operators import sample
    d = sample.split(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 0.2)
    path = os.path.join(tmp_dir, "splits")
    corpus.write_splits(d, path)
    assert sorted(f for f in os.listdir(path) if f.startswith("split=")) == ["split=train", "split=validation"]
    assert corpus.read_splits(spark, path, "validation").count() == d.where("split = 'validation'").count()


def test_a_table_of_one_row_group_is_worked_on_by_all_cores(spark, tmp_dir):
    """Several splits, all but one without a row: dealt out; a table of even splits is read as it is."""
    from pyspark.sql import functions as F
    from corpusmill.sources.corpus import spread
    one, even = f"{tmp_dir}/one", f"{tmp_dir}/even"
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    df.coalesce(1).write.parquet(one)
    df.repartition(4).write.parquet(even)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        scan = spark.read.parquet(one)
        assert 1 < scan.rdd.getNumPartitions() < 8
        rows = [r["count"] for r in spread(scan).groupBy(F.spark_partition_id()).count().collect()]
        assert len(rows) == 4 and max(rows) < 11_000
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        scan = spark.read.parquet(even)
        assert "Exchange" not in spread(scan)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_large_arrow_file_is_read_by_many_tasks(spark, tmp_dir):
    """Ranges of record batches; only the columns of the schema; the streaming format as one partition."""
    import pyarrow as pa
    register(spark)
    table = pa.table({"doc_id": list(range(5000)), "text": [f"text {i} " * 20 for i in range(5000)], "other": ["x" * 50] * 5000})
    os.makedirs(f"{tmp_dir}/a")
    with pa.ipc.new_file(f"{tmp_dir}/a/one.arrow", table.schema) as w:
        w.write_table(table, max_chunksize=100)
    read = spark.read.format("arrow_ipc").option("split_bytes", str(100_000))
    df = read.load(f"{tmp_dir}/a")
    assert df.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, df.collect())) == sorted(zip(*(table[c].to_pylist() for c in table.column_names)))
    some = read.schema("text string, doc_id bigint").load(f"{tmp_dir}/a")
    assert sorted(map(tuple, some.collect())) == sorted(zip(table["text"].to_pylist(), range(5000)))
    os.makedirs(f"{tmp_dir}/b")
    with pa.ipc.new_stream(f"{tmp_dir}/b/one.arrow", table.schema) as w:
        w.write_table(table, max_chunksize=100)
    assert read.schema("doc_id bigint").load(f"{tmp_dir}/b").count() == 5000
