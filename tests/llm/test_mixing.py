import math

import pytest

from corpusmill.llm import mixing

from .helpers import EDGES, documents


def brute_targets(sizes):
    """{source: size} -> {source: target}; excess is shared anew until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), set()
    target = dict.fromkeys(order, 0.0)
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return target
        each = left / sum(w[s] for s in rest)
        over = [s for s in rest if w[s] * each >= 2 * sizes[s]]
        if not over:
            return {**target, **{s: w[s] * each for s in rest}}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            full.add(s)


@pytest.fixture(scope="module")
def rows():
    out = []
    for s, (name, n) in enumerate([("a", 300), ("b", 900), ("Z", 40), ("é", 200), (None, 60)]):
        out += [(1000 * s + i, " ".join(["w"] * (1 + (i * 37 + s * 11) % 400)), "en", name) for i in range(n)]
    return out


def test_targets_and_words_taken(spark, rows):
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    sizes, taken = {}, {}
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = brute_targets(sizes)
    for r in got:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.005 * want[s] + 5, s
    again = mixing.mix(docs.repartition(13)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_rates_are_the_balanced_tilt(spark, rows):
    """Expected words meet the target, and the log rates of a source are proportional to z (where not at the cap)."""
    got = mixing.mix(documents(spark, rows)).collect()
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert math.isclose(sum(r["rate"] * r["size"] for r in own), own[0]["target"], rel_tol=1e-6)
        mean = own[0]["source_size"] / len(own)
        lam = {round(math.log(r["rate"]) / (r["size"] / (r["size"] + mean)), 5) for r in own if 0 < r["rate"] < 2}
        assert len(lam) <= 1


def test_edges(spark):
    got = mixing.mix_rows(mixing.mix(documents(spark, EDGES))).collect()
    assert len(got) == len(EDGES)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None), (2, "")])).select("taken").distinct().collect()[0][0] == 0
    docs = documents(spark, EDGES)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)


def test_plan_has_no_python(spark):
    text = mixing.mix(documents(spark, EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_rows_that_share_id_and_size_differ_by_a_copy(spark, monkeypatch):
    """Null and repeated ids of one size come as near their target as rows with ids of their own."""
    monkeypatch.setattr(mixing, "PART_ROWS", 64)
    rows = [(None, " ".join([f"w{i if i < 200 else 200}"] * 10), "en", "a") for i in range(600)]
    rows += [(7, " ".join([f"x{i if i < 200 else 200}"] * 10), "en", "b") for i in range(400)]
    rows += [(8, " ".join(["y"] * 7), "en", "b") for _ in range(400)] + [(9, None, "en", "c"), (9, None, "en", "c")]
    docs = documents(spark, rows)
    units = mixing.mix(docs).collect()
    assert sum(r["k"] for r in units) == len(rows) == mixing.mix_rows(mixing.mix(docs)).count()
    want, words = {}, {}
    for r in units:
        want[r["source"]] = r["target"]
        words[r["source"]] = words.get(r["source"], 0) + r["taken"] * r["k"]
        assert 0 <= r["copies"] <= mixing.MAX_COPIES and abs(r["copies"] - r["rate"]) <= 2
    assert all(abs(words[s] - want[s]) <= 10 for s in want)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
    assert got == {s: w for s, w in words.items() if w}
