"""Cases in which rows once were lost without an error."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import clean, dedup, sample, sft
from corpusmill.streaming import streams


def test_near_copies_behind_a_template_family(spark):
    """Members unlike their bucket's smallest id are compared with one another."""
    rng = random.Random(1)
    template = [f"t{i}" for i in range(200)]

    def variant(changes):
        w = list(template)
        for i in rng.sample(range(200), changes):
            w[i] = f"x{rng.randrange(10**6)}"
        return w
    rows = [(i, " ".join(variant(14))) for i in range(150)]
    late = template[:100] + [f"z{i}" for i in range(14)] + template[114:]
    rows += [(1000, " ".join(late)), (1001, " ".join(late[:-1] + ["end"])), (1002, " ".join(["start"] + late[1:]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    comp = {r["id"]: r["component"] for r in dedup.components(dedup.near_dup_pairs(df)).collect()}
    assert comp[1000] == comp[1001] == comp[1002] == 1000


def test_components_do_not_end_early(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    assert {r["component"] for r in dedup.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        dedup.components(chain, max_rounds=2)


def test_small_fractions(spark):
    df = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert 60 < sample.hash_sample(df, 0.0005).count() < 150
    n = sample.split(df, 0.00005).where("split = 'validation'").count()
    assert 2 < n < 30


def test_null_strata_are_strata(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "en").alias("lang"))
    got = {r["lang"]: r["count"] for r in sample.stratified_sample(df, ("lang",), 0.1).groupBy("lang").count().collect()}
    assert got == {"en": 10, None: 10}


def test_unreadable_seen_table_fails_the_batch(spark, tmp_dir):
    seen, out = f"{tmp_dir}/seen", f"{tmp_dir}/out"
    batch = spark.createDataFrame([(1, "a text")], "doc_id bigint, text string")
    streams.dedup_batch(batch, 0, seen, out)
    streams.dedup_batch(spark.createDataFrame([(2, "a text"), (3, "new")], "doc_id bigint, text string"), 1, seen, out)
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 3]
    bad = f"{tmp_dir}/bad"
    with open(bad, "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        streams.dedup_batch(batch, 1, bad, out)


def test_alpaca_arrays_and_lines(spark, tmp_dir):
    from corpusmill.sources.corpus import read_alpaca
    rows = [{"instruction": f"i{k}", "input": "", "output": f"o{k}"} for k in range(3)]
    for name, text in (("lines", "\n".join(map(json.dumps, rows))), ("array", json.dumps(rows)), ("pretty", json.dumps(rows, indent=2))):
        path = f"{tmp_dir}/{name}.json"
        with open(path, "w") as f:
            f.write(text)
        assert sorted(r["output"] for r in read_alpaca(spark, path).collect()) == ["o0", "o1", "o2"], name
    with open(f"{tmp_dir}/bad.json", "w") as f:
        f.write('{"instruction": "a"}\nnot json\n')
    with pytest.raises(Exception):
        read_alpaca(spark, f"{tmp_dir}/bad.json").collect()


def test_turns_pair_by_order(spark):
    rows = [(1, 0, "user", "q"), (1, 7, "assistant", "a"), (2, 0, "system", "s"), (2, 5, "user", "q2"), (2, 9000, "assistant", "a2"),
            (2, 9001, "user", "q3"), (2, 9002, "user", "q4"), (2, 20000, "assistant", "a4")]
    got = {(r["conv_id"], r["turn"]): (r["instruction"], r["input"], r["output"])
           for r in sft.sft_pairs(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {(1, 0): ("q", "", "a"), (2, 5): ("q2", "s", "a2"), (2, 9002): ("q4", "s", "a4")}


def test_records_differ_by_where_a_text_ends(spark):
    rows = [(1, 0, "a", "\x01b", "c"), (2, 0, "a\x01", "b", "c"), (3, 0, "a", "\x01b", "c"), (4, 0, "ab", "", "c"), (5, 0, "a", "b", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, instruction string, input string, output string")
    assert sorted(r["conv_id"] for r in sft.sft_filter(df).collect()) == [1, 2, 4, 5]


def test_funnel_takes_its_keywords(spark):
    df = spark.createDataFrame([(1, "word " * 80, "en", "s")], "doc_id bigint, text string, lang string, source string")
    assert clean.standard_funnel(df, length_kw={"min_chars": 1000}).where("stage = 'length'").count() == 0


def test_a_table_is_read_anew(spark, tmp_dir):
    from corpusmill.sources.corpus import table
    spark.range(5).write.parquet(f"{tmp_dir}/documents.parquet")
    assert table(spark, tmp_dir, "documents").count() == 5
    spark.range(9).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert table(spark, tmp_dir, "documents").count() == 9


def test_a_cluster_needs_a_shared_folder(spark):
    from corpusmill.session import ensure_checkpoint_dir

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf)

    class Session:
        sparkContext = Context
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)


def test_hot_key_joins_are_split(spark):
    """A third of all rows on one key: the join with the written aggregate is a skew join."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        from corpusmill.operators.joins import materialize
        rows = materialize(spark.range(0, 60_000, 1, 12).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")))
        least = materialize(rows.groupBy("k").agg(F.min("id").alias("least")))
        out = rows.join(least, "k").where("id <> least")
        assert out.count() == 19_999
        out.write.format("noop").mode("overwrite").save()
        qe = out._jdf.queryExecution()
        out.collect()
        assert "skew=true" in qe.executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
