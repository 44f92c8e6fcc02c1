import re

from corpusmill.llm import quality

from .helpers import EDGES, collected, documents


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    marked = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked), len(lines)


def test_measure_equals_brute_force():
    for t in [None, "", " ", "a a a a", "a b c a b c", "x\n \nx\ny\nx", "a#b *** <c> | %\n a#b", "é b \x85c", "a b c\x0ba b c\x1c"] + [r[1] for r in EDGES if r[1] and len(r[1]) < 999]:
        assert quality.measure(t) == brute(t), repr(t)


def test_verdicts(spark):
    good = " ".join(f"w{i}" for i in range(60))
    soft = good + " " + "### " * 8
    rows = [(i, good, "en", "good") for i in range(30)] + [(100 + i, soft, "en", "bad") for i in range(30)] + \
           [(200, good, "en", "bad"), (201, soft, "en", "good"), (202, "few words", "en", "good"), (203, "a b c " * 60, "en", "good")]
    got = {r["doc_id"]: r for r in quality.quality_verdicts(documents(spark, rows)).collect()}
    assert got[0]["kept"] and got[201]["kept"] and got[200]["kept"]            # no clean document goes for its host
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert got[202]["base_failed"] and got[203]["base_failed"] and not got[203]["kept"]
    assert got[100]["host_rate"] > 0.5 > got[0]["host_rate"]
    docs = documents(spark, rows)
    left = quality.quality_filter(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, r in got.items() if r["kept"])


def test_shrinkage_needs_evidence(spark):
    """Three bad documents of a small host do not reject it when hosts scarcely differ."""
    stats = [(f"h{i}", j % 10 == 0) for i in range(20) for j in range(200)] + [("small", True)] * 3
    v = {r["host"]: r for r in quality.host_verdicts(spark.createDataFrame(stats, "host string, failed boolean")).collect()}
    assert not v["small"]["rejected"] and v["small"]["rate"] < 0.5


def test_edges(spark):
    got = collected(quality.quality_verdicts(documents(spark, EDGES)), "doc_id", "n_words")
    assert len(got) == len(EDGES)
    by = {r["doc_id"]: r for r in got}
    for i in (2, 3, 4):
        assert by[i]["n_words"] == 0 and by[i]["base_failed"] and not by[i]["kept"]
    assert by[5]["n_words"] == 30_000 and by[5]["kept"]
    assert quality.quality_verdicts(documents(spark, [])).count() == 0
    assert quality.quality_filter(documents(spark, [])).count() == 0
