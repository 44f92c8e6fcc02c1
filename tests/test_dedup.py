import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup
from tests.conftest import SF001


def test_components_chain(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (3, 7)], "a bigint, b bigint")
    comp = {r["id"]: r["component"] for r in dedup.components(pairs).collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10}


def _shingles(text, n=5):
    w = re.findall(r"[^ \t\n\r]+", text.lower())
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}


def test_near_dups_vs_brute_force(spark):
    """Every pair with exact Jaccard >= 0.8 (brute force) ends in one component;
    every emitted edge is a true near-duplicate pair."""
    d = spark.read.parquet(f"{SF001}/documents.parquet").where(F.col("doc_id") < 400)
    rows = {r["doc_id"]: _shingles(r["text"]) for r in d.collect()}
    truth = set()
    for a, b in itertools.combinations(sorted(rows), 2):
        sa, sb = rows[a], rows[b]
        if sa and sb:
            j = len(sa & sb) / len(sa | sb)
            if round(j, 6) >= 0.8:
                truth.add((a, b))
    edges = dedup.near_dup_pairs(d)
    got = [(r["a"], r["b"], r["jaccard"]) for r in edges.collect()]
    for a, b, j in got:
        sa, sb = rows[a], rows[b]
        assert a < b and abs(len(sa & sb) / len(sa | sb) - j) < 1e-6 and j >= 0.8
    comp = {r["id"]: r["component"] for r in dedup.components(edges).collect()}
    for a, b in truth:
        assert comp.get(a, a) == comp.get(b, b), (a, b)


def test_near_dedup_keeps_component_min(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j k"),
                                (3, "completely different words in this one here")], "doc_id bigint, text string")
    pairs = dedup.near_dup_pairs(df)
    kept = sorted(r["doc_id"] for r in dedup.near_dedup(df, pairs).collect())
    assert kept == [1, 3]


def test_components_long_chain(spark):
    n = 200
    pairs = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    comp = dedup.components(pairs, max_rounds=30)
    assert {r["component"] for r in comp.collect()} == {0}


def test_hot_duplicate_group(spark):
    """A third of the corpus is one text (plus case/space variants): results stay exact and edges linear."""
    hot = "the same boilerplate page text repeated across many crawled sources again and again today"
    rows = [(i, hot if i % 3 else hot.upper() + "  ") for i in range(0, 90)]
    rows += [(1000 + i, f"unique document number {i} with its own words {i * 7} and more {i * 13} tokens here")
             for i in range(180)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    kept = sorted(r["doc_id"] for r in dedup.exact_dedup(df).collect())
    assert kept == [0] + [1000 + i for i in range(180)]
    edges = dedup.near_dup_pairs(df)
    assert edges.count() <= df.count()           # star edges: linear, never all pairs of the group
    comp = {r["id"]: r["component"] for r in dedup.components(edges).collect()}
    assert all(comp.get(i, i) == 0 for i in range(90))


def brute_components(rows):
    """{id: smallest id reachable over pairs of Jaccard 0.8 or more}, all pairs compared."""
    sets = {i: _shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and round(len(x & y) / len(x | y), 6) >= 0.8:
            ra, rb = sorted((root(a), root(b)))
            up[rb] = ra
    return {i: root(i) for i in sets}


def template_families(rng):
    """Many low ids that are like their template but not like one another, then two near copies of it."""
    rows = []
    for t in range(5):
        words = [f"t{t}x{i}" for i in range(150)]
        for i in range(120):
            w = list(words)
            for k in rng.sample(range(150), 6):
                w[k] = f"v{rng.randrange(10**9)}"
            rows.append((t * 200 + i, " ".join(w)))
        for j in range(2):
            w = list(words)
            for k in rng.sample(range(150), 2):
                w[k] = f"c{rng.randrange(10**9)}"
            rows.append((10_000 + 2 * t + j, " ".join(w)))
    return rows


def chains(rng):
    """Each document is its predecessor with a word changed: the ends of a chain share nothing."""
    rows = []
    for c in range(6):
        w = [f"k{c}x{i}" for i in range(60)]
        for i in range(50):
            w[(i * 7) % 60] = f"e{rng.randrange(10**9)}"
            rows.append((c * 100 + i, " ".join(w)))
    rng.shuffle(rows)
    return rows


def lengths(rng):
    """Beginnings of one text, of many lengths, behind a heading that all documents share; some with repeated words."""
    head, rows = [f"head{i}" for i in range(30)], []
    for c in range(8):
        body = [f"b{c}x{i}" for i in range(300)]
        for i in range(30):
            n = rng.randint(20, 300)
            w = head + (body[:n] if i % 5 else body[:n // 3] * 3)
            rows.append((c * 50 + i, " ".join(w)))
    rows += [(900 + i, " ".join(head[:i])) for i in range(12)] + [(950, None), (951, "")]
    return rows


@pytest.mark.parametrize("shape", [template_families, chains, lengths])
def test_no_pair_is_lost(spark, shape):
    rows = shape(random.Random(9))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    edges = dedup.near_dup_pairs(df)
    comp = {r["id"]: r["component"] for r in dedup.components(edges).collect()}
    want = brute_components([(i, t or "") for i, t in rows])
    assert {i: comp.get(i, i) for i, _ in rows} == want
    sets = {i: _shingles(t or "") for i, t in rows}
    for a, b, j in edges.collect():
        assert a < b and abs(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) - j) < 1e-6 and j >= 0.8


def test_prefixes_hold_the_first_common_shingle(spark):
    """Of two similar sets at least one shingle is indexed for both, within the other's bounds."""
    rng = random.Random(4)
    rows = []
    for i in range(120):
        w = [f"s{rng.randrange(25)}" for _ in range(rng.randint(5, 60))]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w + [f"n{i}"] * rng.randint(0, 4)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = dedup.shingle_hashes(df).selectExpr("doc_id id", "sh").where("size(sh) > 0")
    index: dict = {}
    for r in dedup.rare_prefixes(sets, 0.8).collect():
        index.setdefault(r["s"], []).append((r["id"], r["len"], r["upto"]))
    met = {(min(a, b), max(a, b)) for rows_ in index.values() for (a, x, u), (b, y, v) in itertools.combinations(rows_, 2) if x <= v and y <= u}
    full = {r["id"]: set(r["sh"]) for r in sets.collect()}
    for a, b in itertools.combinations(sorted(full), 2):
        if len(full[a] & full[b]) >= 0.8 * len(full[a] | full[b]):
            assert (a, b) in met


def test_edges_grow_with_the_group(spark):
    """A third of all documents are near copies of one another: about an edge each, not one per pair."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(600):
        w = list(words)
        w[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"o{i}x{k}" for k in range(40))) for i in range(1200)]
    edges = dedup.near_dup_pairs(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert edges.count() < 3000
    assert {r["component"] for r in dedup.components(edges).collect()} == {0}


def test_rare_prefixes_count_and_order_in_one_pass(spark):
    import math
    import random
    from collections import Counter
    rng = random.Random(5)
    sets = {i: sorted(rng.sample(range(60), rng.randint(5, 20))) for i in range(40)}
    n = Counter(s for x in sets.values() for s in x)
    want, t = set(), 0.7
    for i, x in sets.items():
        ts = sorted((n[s], s) for s in x if n[s] > 1)
        alone, least = len(x) - len(ts), math.ceil(len(x) * t)
        for at, (_, s) in enumerate(ts[:max(0, len(x) - least + 1 - alone)]):
            upto = math.floor((len(x) - alone - at) * (1 + t) / t + 1e-6) - len(x)
            if upto >= math.ceil(len(x) * t - 1e-6):
                want.add((i, len(x), s, upto))
    df = spark.createDataFrame(list(sets.items()), "id bigint, sh array<bigint>")
    got = dedup.rare_prefixes(df, t)
    assert {tuple(r) for r in got.collect()} == want
    # Every shingle of the sets crosses the shuffle once: no join of them all with the table of their counts.
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def brute_pairs(rows):
    """(a, b, Jaccard) for each two rows of unequal ids and Jaccard 0.8 or more, all compared."""
    sets = sorted(((i, _shingles(t or "")) for i, t in rows if i is not None), key=lambda r: r[0])
    out = []
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        j = round(len(x & y) / len(x | y), 6) if x and y else 0
        if a < b and j >= 0.8:
            out.append((a, b, j))
    return sorted(out)


@pytest.mark.parametrize("per_task", [dedup.PAIRS_PER_TASK, 50])
def test_the_query_has_every_similar_pair(spark, tmp_dir, monkeypatch, per_task):
    """Not only the edges that link: near copies of near copies, copies of either, repeated rows, missing ids."""
    import __spark_entry__
    monkeypatch.setattr(dedup, "PAIRS_PER_TASK", per_task)
    rng = random.Random(3)
    rows = [r for r in chains(rng) if r[0] < 130]
    words = [f"w{i}" for i in range(100)]
    for i in range(40):
        w = list(words)
        w[rng.randrange(100)] = f"x{i % 25}"
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000 + i, " ".join(words).upper()) for i in range(15)] + [(3000 + i, f"its own words {i} and {i} more") for i in range(10)]
    rows += [(2003, " ".join(words)), (1001, rows[0][1]), (None, " ".join(words)), (4000, None), (4001, "too short")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(tuple(r) for r in __spark_entry__.queries()["near_dup_pairs"](spark, tmp_dir).collect())
    want = brute_pairs(rows)
    assert got == want
    assert len(want) > 1200 > 3 * len(rows)
