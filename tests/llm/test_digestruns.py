import hashlib
import random

from pyspark.sql import functions as F

from corpusmill.llm import digestruns

from .helpers import EDGES, documents


def brute(rows, largest):
    """(doc_id, keep_id, group_size, kept, sha) per row, from a plain dictionary of texts."""
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out, taken = [], set()
    for i, t in rows:
        g = groups[t or ""]
        known = [x for x in g if x is not None]
        keep = (max if largest else min)(known) if known else None
        kept = i == keep and (t or "") not in taken
        if kept:
            taken.add(t or "")
        out.append((i, keep, len(g), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in digestruns.exact_groups(df, **kw).collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(60)}" if i % 3 == 1 else f"own {i}") for i in range(600)]
    rows += [(None, "hot"), (None, "only null"), (None, "only null"), (7, None), (8, ""), (599, "own 599"), (599, "own 599")]
    rng.shuffle(rows)
    for parts in (1, 5, 40):
        df = documents(spark, rows).repartition(parts)
        for keep in ("largest", "smallest"):
            assert got(df, keep=keep) == brute(rows, keep == "largest"), (parts, keep)


def test_rounds_join_runs_of_any_number(spark):
    """A digest that stands once in every run is one group, whatever the fan-in."""
    df = spark.range(37, numPartitions=37).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    for bits in (1, 2, 3, 6):
        merged = digestruns.merged(digestruns.entries(df), "smallest", bits).collect()
        assert [(r["best"]["doc_id"], r["n"]) for r in merged] == [(0, 37)]


def test_no_more_than_the_partners_meet_in_a_round(spark):
    """Every round is one exchange by address, with no other shuffle behind it."""
    plan = digestruns.merged(digestruns.entries(spark.range(64, numPartitions=64).selectExpr("id doc_id", "'x' text")))._jdf.queryExecution()
    assert "hashpartitioning" not in plan.toString()


def test_a_normal_form_and_kept_rows(spark):
    rows = [(1, "A  b"), (2, "a b"), (3, "c"), (3, "c"), (4, "c"), (None, "d")]
    df = documents(spark, rows)
    out = digestruns.deduplicated(df, normalise=lambda t: F.regexp_replace(F.lower(t), " +", " "))
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "d"), (1, "A  b"), (3, "c")]


def test_edges(spark):
    rows = [(r[0], r[1]) for r in EDGES]
    assert got(documents(spark, EDGES), keep="largest") == brute(rows, True)
    assert digestruns.exact_groups(documents(spark, [])).count() == 0
    assert digestruns.deduplicated(documents(spark, [])).count() == 0
