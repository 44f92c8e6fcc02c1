import pytest
from pyspark.sql import functions as F

from corpusmill.operators import encode
from corpusmill.operators import windows as W

L, O = 8, 2
S = L - O


def encoded(spark, lengths, start=1):
    rows = [(i, list(range(start, start + n))) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "doc_id bigint, input_ids array<int>").withColumn(
        "n_tokens", F.size("input_ids").cast("bigint"))


def expected_count(n):
    if n == 0:
        return 0
    if n <= L:
        return 1
    return 1 + -(-(n - L) // S)


EDGES = [0, 1, L - 1, L, L + 1, L + S, L + S + 1, 3 * L]


def test_window_counts_and_cover(spark):
    enc = encoded(spark, EDGES)
    w = W.windows(enc, L, O).collect()
    by_doc = {}
    for r in w:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, n in enumerate(EDGES):
        wins = sorted(by_doc.get(doc, []), key=lambda r: r["window_ix"])
        assert len(wins) == expected_count(n)
        covered = set()
        for i, r in enumerate(wins):
            ids = list(r["input_ids"])
            assert ids == list(range(1 + i * S, 1 + min(n, i * S + L)))
            assert r["n_tokens"] == len(ids)
            covered.update(ids)
            if i > 0:   # neighbours overlap by exactly O (or the whole short tail)
                prev = set(wins[i - 1]["input_ids"])
                assert len(prev & set(ids)) == min(O, len(ids))
        assert covered == set(range(1, n + 1))


def test_sample_count_matches_windows(spark):
    enc = encoded(spark, EDGES)
    c = W.sample_count(enc, L, O).collect()[0]
    assert c["samples"] == sum(expected_count(n) for n in EDGES)
    assert c["documents"] == len(EDGES)


def test_index_batches_dense_and_ordered(spark):
    enc = encoded(spark, EDGES).repartition(3)
    idx = W.indexed_windows(enc, L, O)
    rows = sorted(idx.collect(), key=lambda r: (r["doc_id"], r["window_ix"]))
    assert [r["sample_id"] for r in rows] == list(range(len(rows)))
    b = W.batches(idx, 4).collect()
    for r in b:
        assert r["batch_id"] == r["sample_id"] // 4 and r["pos"] == r["sample_id"] % 4
    again = W.sample_index(W.windows(enc, L, O)).select("doc_id", "window_ix", "sample_id")
    assert sorted(map(tuple, again.collect())) == sorted((r["doc_id"], r["window_ix"], r["sample_id"]) for r in rows)


def test_collate_mask_by_position(spark):
    # id 0 (the pad id) inside real tokens must keep mask 1 and its label
    df = spark.createDataFrame([(0, [5, 0, 7])], "sample_id bigint, input_ids array<int>")
    c = W.lm_labels(W.collate(df, 6, 0)).collect()[0]
    assert list(c["input_ids"]) == [5, 0, 7, 0, 0, 0]
    assert list(c["attention_mask"]) == [1, 1, 1, 0, 0, 0]
    assert list(c["labels"]) == [5, 0, 7, -100, -100, -100]


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        W.window_count(F.lit(3), 4, 4)


def test_epochs_accum_shards(spark):
    b = spark.range(10).select(F.col("id").alias("batch_id"))
    e = W.epochs(b, 3)
    assert e.count() == 30
    a = {r["batch_id"]: r["step"] for r in W.accum_groups(b, 4).collect()}
    assert a[7] == 1 and a[8] == 2
    s = W.worker_shards(b, 4).groupBy("shard").count().collect()
    assert sum(r["count"] for r in s) == 10 and len(s) == 4


def test_collate_plugins(spark):
    import pyarrow as pa
    df = spark.createDataFrame([(0, [5, 6])], "sample_id bigint, input_ids array<int>")
    c = W.collate_with(df, max_seq_length=4, pad_id=9).collect()[0]
    assert list(c["input_ids"]) == [5, 6, 9, 9]

    def lengths(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(x) for x in b.column("input_ids").to_pylist()]})
    assert W.collate_arrow(df, lengths, "n long").collect()[0]["n"] == 2


def test_token_arrays_are_not_shuffled(spark):
    """collate and sft_batches: what is exchanged are texts and counts, in the written part and in the rest."""
    from corpusmill.operators import sft
    from corpusmill.plans import registry
    from tests.conftest import SF0001
    for name in ("collate", "lm_labels", "sft_batches"):
        plan = registry.QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x], name
    tok = encode.WordTokenizer(encode.word_vocab(spark.createDataFrame([("a b c",)], "text string")))
    df = spark.createDataFrame([(3, 1, "a b", "c"), (1, 2, "b", "a"), (1, 1, "", "c c")], "conv_id bigint, turn int, prompt string, output string")
    out = sft.sft_encode(df, tok)
    text = out._jdf.queryExecution().toString()
    assert "Join" not in text
    assert [(r["conv_id"], r["turn"], r["prompt_tokens"], r["response_tokens"]) for r in sft.sft_batches(out).orderBy("sample_id").collect()] == \
        [(1, 1, 0, 3), (1, 2, 1, 2), (3, 1, 2, 2)]


def test_ordered_windows_equal_the_shuffled_index(spark):
    """Any partitioning of the documents gives the sample ids of the index over encoded rows."""
    import random
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([0, 1, 7, 8, 9, 40])))) for i in rng.sample(range(1000), 300)] + [(2000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    tok = encode.WordTokenizer.train(df)
    want = W.indexed_windows(tok.encode_df(df), 8, 2).select("sample_id", "doc_id", "window_ix", "input_ids", "n_tokens").orderBy("sample_id").collect()
    for parts in (1, 7):
        got = W.ordered_windows(df.repartition(parts), tok, 8, 2).select(*want[0].__fields__).orderBy("sample_id").collect()
        assert got == want and [r["sample_id"] for r in got] == list(range(len(got)))
