import hashlib
import math

from pyspark.sql import functions as F

from corpusmill.operators import sample
from tests.conftest import SF001


def bucket(i, seed):
    return int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16)


def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_hash_sample_formula_and_partition_invariance(spark):
    d = docs(spark)
    ids = [r["doc_id"] for r in d.select("doc_id").collect()]
    want = sorted(i for i in ids if bucket(i, 42) % 1000 < 100)
    for parts in (1, 7):
        got = sorted(r["doc_id"] for r in sample.hash_sample(d.repartition(parts)).collect())
        assert got == want


def test_split_disjoint_complete(spark):
    s = sample.split(docs(spark)).groupBy("split").count().collect()
    assert sum(r["count"] for r in s) == docs(spark).count()
    assert {r["split"] for r in s} <= {"train", "validation"}


def test_budget_sample_brute_force(spark):
    d = docs(spark)
    rows = sorted(((bucket(r["doc_id"], 42), r["doc_id"], len(r["text"].encode())) for r in d.collect()))
    for budget in (0, 1, 100_000, 10**12):
        cum, want = 0, []
        for _, i, b in rows:
            cum += b
            if cum > budget:
                break
            want.append(i)
        got = sorted(r["doc_id"] for r in sample.budget_sample(d.repartition(5), budget).collect())
        assert got == sorted(want)


def test_stratified_brute_force(spark):
    d = docs(spark)
    strata = {}
    for r in d.collect():
        strata.setdefault((r["lang"], r["source"]), []).append((bucket(r["doc_id"], 42), r["doc_id"]))
    want = []
    for rows in strata.values():
        rows.sort()
        want += [i for _, i in rows[:math.ceil(len(rows) * 0.1 - 1e-9)]]
    got = sorted(r["doc_id"] for r in sample.stratified_sample(d, fraction=0.1).collect())
    assert got == sorted(want)


def test_cluster_split_keeps_copies_together(spark):
    from corpusmill.operators import dedup
    d = docs(spark)
    comp = dedup.dup_components(d)
    cs = sample.cluster_split(d, comp, val_fraction=0.2)
    rep = sample.split_report(cs, comp).collect()
    assert all(r["cross_exact"] == 0 and r["cross_near"] == 0 for r in rep)
    assert sum(r["rows"] for r in rep) == d.count()
