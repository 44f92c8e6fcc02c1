import duckdb

import __spark_entry__ as E
from corpusmill.sources.corpus import TABLES
from tests.conftest import SF0001

FAST = ["select_text", "normalize_text", "length_filter", "quality_filter", "exact_dedup", "hash_sample",
        "split", "pretoken_counts", "word_encode", "windows", "sample_count", "pii_redact", "decontaminate",
        "budget_sample", "stratified_sample", "batches", "lm_labels", "sft_encode", "clean_funnel", "near_dedup"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "documents", "tokens", "samples"] and len(rows) >= 1


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


def test_fast_queries_match_duckdb_at_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in FAST:
        sdf = qs[name](spark, SF0001)
        cols = sorted(sdf.columns)
        srows = sorted("|".join(_norm(r[c]) for c in cols) for r in sdf.collect())
        rel = con.sql(sql[name])
        dcols = rel.columns
        assert sorted(dcols) == cols, name
        drows = sorted("|".join(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall())
        assert srows == drows, name
