import duckdb

import corpus_pipeline
from corpusmill.llm import decontam, quality
from corpusmill.llm.common import saved, table
from corpusmill.llm.queries import ORACLE, QUERIES
from tests.conftest import SF0001

from .helpers import EDGES, documents
from .test_decontam import brute as leaks
from .test_pii import brute as personal
from .test_simhash import brute_components, brute_print


def test_stages_against_brute_force(spark):
    """Each stage keeps of its own input what a plain scan keeps, with the columns of documents."""
    docs = table(spark, SF0001, "documents")
    columns = docs.columns
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF0001, "benchmark").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF0001), f"test-{name}")
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        ids = sorted(before)
        if name == "quality_rules":
            poor = {i for i in ids if quality.base_failed(quality.measure(before[i])[0], quality.measure(before[i])[4])}
            assert not poor & set(after)
            # what else went had symbols or repeated lines
            for i in set(before) - set(after) - poor:
                words, _, symbols, dup, _, lines = quality.measure(before[i])
                assert 10 * symbols > words or 100 * dup > 30 * lines
        elif name == "simhash_near_dedup":
            comp = brute_components([brute_print(before[i]) for i in ids], ids, 2)
            assert set(after) == {i for i, c in zip(ids, comp) if i == c}
        elif name == "benchmark_decontamination":
            assert set(after) == {i for i in ids if not leaks(before[i], bench)}
        else:
            assert set(after) == set(before)
            for i in ids:
                assert not personal(after[i])
                if not personal(before[i]):
                    assert after[i] == before[i]
        before = after if name == "pii" else {i: before[i] for i in after}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001)
    assert mixed.columns == columns
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r["text"] == before[r["doc_id"]]
    assert max(times.values()) <= 2


def test_run_on_awkward_rows(spark, tmp_dir):
    documents(spark, EDGES, extra=False).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, "word0x0 word1x1 word2x2")], "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, tmp_dir).collect()} <= {5}
    empty = f"{tmp_dir}/empty"
    documents(spark, [], extra=False).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    assert set(ORACLE) < set(QUERIES) and len(QUERIES) == 13
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF0001)
        rel = con.sql(sql)
        assert sorted(rel.columns) == sorted(df.columns)
        got = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
        at = [rel.columns.index(c) for c in sorted(df.columns)]
        assert [repr(x) for x in got] == [repr(x) for x in sorted(tuple(r[i] for i in at) for r in rel.fetchall())], name
