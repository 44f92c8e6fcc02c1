"""Results do not depend on how the input is partitioned (survey §5: repartition 1 / 7 / 64)."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import clean, dedup, encode, sample
from corpusmill.operators import windows as W
from tests.conftest import SF0001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


OPS = {
    "exact_dedup": lambda d: dedup.exact_dedup(d).select("doc_id"),
    "line_dedup": lambda d: clean.line_dedup(d.select("doc_id", "text"), min_words=3, min_docs=3),
    "stratified": lambda d: sample.stratified_sample(d, fraction=0.2).select("doc_id"),
    "budget": lambda d: sample.budget_sample(d, 50_000).select("doc_id"),
    "index": lambda d: W.indexed_windows(
        encode.word_encode(d, encode.word_vocab(d, 500)), 64, 16).select("doc_id", "window_ix", "sample_id"),
    "near": lambda d: dedup.near_dedup(d, dedup.near_dup_pairs(d)).select("doc_id"),
}


@pytest.mark.parametrize("op", sorted(OPS))
def test_partitioning_invariance(spark, op):
    d = spark.read.parquet(f"{SF0001}/documents.parquet")
    base = _rows(OPS[op](d.repartition(1)))
    for n in (7, 64):
        assert _rows(OPS[op](d.repartition(n))) == base, (op, n)
    assert len(base) > 0
