import os

from pyspark.sql import functions as F

from corpusmill.operators import dedup
from corpusmill.sources.corpus import DOCUMENTS_SCHEMA
from corpusmill.streaming import streams


def write_file(spark, d, name, rows):
    spark.createDataFrame(rows, DOCUMENTS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(d, name))


def test_stream_dedup_first_arrival_and_replay(spark, tmp_dir):
    src, seen, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "seen", "out", "ck"))
    os.makedirs(src)
    batches = [
        [(5, "Alpha beta", "en", "s", 10), (2, "alpha  BETA", "en", "s", 11), (7, "gamma", "en", "s", 5)],
        [(1, "alpha beta", "en", "s", 10), (8, "delta", "en", "s", 5)],
        [(3, "delta", "en", "s", 5), (9, "epsilon", "en", "s", 7), (4, "epsilon", "en", "s", 7)],
    ]
    for i, rows in enumerate(batches):
        write_file(spark, src, f"b{i}", rows)
        q = streams.stream_dedup(streams.stream_corpus(spark, src + "/*"), seen, out, ck)
        q.awaitTermination()
    got = sorted(r["doc_id"] for r in spark.read.parquet(out).collect())
    assert got == [2, 4, 7, 8]          # first arrival wins; inside a batch the smallest id
    # Replaying micro-batch 1 (e.g. after a failure before its commit) changes nothing.
    replay = spark.createDataFrame(batches[1], DOCUMENTS_SCHEMA)
    ids = sorted(r["batch_id"] for r in spark.read.parquet(out).select("batch_id").distinct().collect())
    streams.dedup_batch(replay, ids[1], seen, out)
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == got


def test_stream_clean_equals_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d.repartition(3).write.parquet(src)
    streams.stream_clean(streams.stream_corpus(spark, src, max_files_per_trigger=1), out, ck).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).select("doc_id", "text").collect()))
    want = sorted(map(tuple, streams.clean_rows(d).select("doc_id", "text").collect()))
    assert got == want


def test_stream_sample_count_equals_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d.repartition(4).write.parquet(src)
    streams.stream_sample_count(streams.stream_corpus(spark, src, max_files_per_trigger=2), out, ck).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, streams.sample_count_agg(d).collect()))
    assert got == want


def test_seen_keys_stay_few_files(spark, tmp_dir):
    """Batches and a replay of any of the last ones: first arrival wins, the number of files does not grow with the stream."""
    seen, out = os.path.join(tmp_dir, "seen"), os.path.join(tmp_dir, "out")
    batches = [[(b * 10 + i, f"text {(b * 3 + i) % 37}", "en", "s", 1) for i in range(6)] for b in range(24)]
    first, counts = {}, []
    for b, rows in enumerate(batches):
        for i, t, *_ in rows:
            first.setdefault(t, i)
        df = spark.createDataFrame(rows, DOCUMENTS_SCHEMA).coalesce(1)
        streams.dedup_batch(df, b, seen, out, compact=4)
        if b % 7 == 3:
            streams.dedup_batch(df, b, seen, out, compact=4)             # a replay, also of a batch that merged
        counts.append(sum(f.endswith(".parquet") for _, _, fs in os.walk(seen) for f in fs))
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == sorted(first.values())
    assert max(counts) <= 2 * 37 + 8 and len([d for d in os.listdir(f"{seen}/merged") if d.startswith("upto=")]) <= 2


def test_chained_counts_equal_batch(spark, tmp_dir):
    """documents -> windows of BPE ids -> counts, in two streams that restart; a replayed batch adds nothing."""
    from pyspark.sql import functions as F
    from corpusmill.operators import bpe
    from corpusmill.operators import windows as W
    src, win, out = (os.path.join(tmp_dir, x) for x in ("src", "win", "out"))
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = bpe.BpeTokenizer.train(d.limit(50), bpe.FIRST_MERGE_ID + 100)
    parts = d.randomSplit([1.0, 1.0], 3)
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(src)
        streams.stream_windows(streams.stream_corpus(spark, src, max_files_per_trigger=1), tok, win, os.path.join(tmp_dir, "ck1"), 64, 16).awaitTermination()
        streams.stream_window_count(spark, win, out, os.path.join(tmp_dir, "ck2"), 16).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    enc = tok.encode_df(streams.clean_rows(d)).join(d.select("doc_id", "lang"), "doc_id").where("n_tokens > 0")
    want = enc.groupBy("lang").agg(F.count(F.lit(1)), F.sum("n_tokens"), F.sum(W.window_count("n_tokens", 64, 16)))
    assert got == sorted(map(tuple, want.collect())) and got


def test_stream_queries_read_a_folder_of_documents(spark, tmp_dir):
    from corpusmill.plans.registry import QUERIES
    from corpusmill.session import prepare
    prepare(spark)
    rows = [(i, f"w{i % 3} b", ("en", "de")[i % 2], "s", 4) for i in range(6)]
    spark.createDataFrame(rows, DOCUMENTS_SCHEMA).repartition(3).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    spark.createDataFrame([(1, "other")], "id int, text string").write.parquet(os.path.join(tmp_dir, "pages.parquet"))
    assert sorted(r["doc_id"] for r in QUERIES["stream_docs"](spark, tmp_dir).collect()) == list(range(6))
    assert sorted(r["doc_id"] for r in QUERIES["stream_dedup"](spark, tmp_dir).collect()) == [0, 1, 2]
    got = {r["lang"]: (r["documents"], r["tokens"]) for r in QUERIES["stream_sample_count"](spark, tmp_dir).collect()}
    assert got == {"en": (3, 6), "de": (3, 6)}
