import math
import random
from collections import Counter

from corpusmill.llm import decontam

from .helpers import EDGES, documents


def block_of(items):
    n = len(items)
    df = Counter(t for _, x in items for t in set(decontam.words(x)))
    idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
    return decontam.Block(items, idf, sum(len(decontam.words(x)) for _, x in items) / n)


def make_items(rng, n, lo=12, hi=70, vocabulary=500):
    return [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(rng.randint(lo, hi)))) for i in range(n)]


def test_wand_retrieves_all_above_threshold():
    rng = random.Random(2)
    decontam.POSTING_BLOCK, old = 4, decontam.POSTING_BLOCK
    try:
        block = block_of(make_items(rng, 120))
        for ix in block.indexes:
            for _ in range(60):
                terms = sorted(rng.sample(range(len(ix.postings)), min(len(ix.postings), rng.randint(1, 60))))
                score = Counter()
                for t in terms:
                    for i, x in zip(ix.postings[t].items, ix.postings[t].impacts):
                        score[i] += x
                for theta in (0.2, 0.4, 0.7):
                    got = dict(ix.retrieve(terms, theta))
                    assert set(got) == {i for i, s in score.items() if s >= theta - 1e-9}
                    assert all(abs(got[i] - score[i]) < 1e-9 for i in got)
    finally:
        decontam.POSTING_BLOCK = old


def brute(text, items, overlap=0.8):
    """Items that are wholly there, by shingles of the whole text."""
    seen = decontam.shingles(decontam.words(text))
    return {i for i, x in items if decontam.words(x) and len(p := decontam.shingles(decontam.words(x))) and
            sum(g in seen for g in p) / len(p) >= overlap}


def test_equals_scan_of_all_items(spark):
    rng = random.Random(3)
    items = make_items(rng, 60) + [(100, "What is the name of the seventh moon? It is the small grey one."), (101, " ".join(f"x{i}" for i in range(400)))]
    rows = list(EDGES)
    for i in range(60):
        w = [f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 900))]
        k, x = rng.choice(items)
        t = decontam.words(x)
        if i % 4 == 0:
            t = t[:len(t) // 2]                            # half an item is no leak
        if i % 4 == 1:
            t[len(t) // 2] = "changed" if len(t) > 40 else t[len(t) // 2]
        at = rng.randrange(len(w) + 1)
        rows.append((100 + i, " ".join(w[:at]) + "\n" + rng.choice([" ", ", "]).join(t).upper() + ". " + " ".join(w[at:])))
    bench = spark.createDataFrame([(i, x, "clash") for i, x in items] + [(500, None, ""), (501, "...", "")], "item_id bigint, text string, score string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents(spark, rows), bench).collect()}
    want = {(r[0], i) for r in rows for i in (brute(r[1], items) if r[1] else ())}
    assert got == want and len(want) > 30
    left = decontam.decontaminate(documents(spark, rows), bench)
    assert left.columns == documents(spark, rows).columns
    assert left.count() == len(rows) - len({d for d, _ in want})


def test_verbatim_items_of_any_length_are_found(spark):
    """Items of 1 to 20 words without a sentence end, at the start, in the middle and at the end of a text, and alone."""
    rng = random.Random(11)
    items = [(n * 10 + k, " ".join(f"q{n}x{k}x{i}" for i in range(n))) for n in range(1, 21) for k in range(3)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows, want = [], set()
    for d, (i, x) in enumerate(items):
        other = [f"w{rng.randrange(500)}" for _ in range(60)]
        for k, t in enumerate((x, x + " " + " ".join(other), " ".join(other[:30]) + " " + x + " " + " ".join(other[30:]), " ".join(other) + " " + x)):
            rows.append((d * 10 + k, t))
            want.add((d * 10 + k, i))
        half = " ".join(x.split()[:len(x.split()) // 2])
        rows.append((d * 10 + 5, " ".join(other) + " " + half))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents(spark, rows), bench).collect()}
    assert got == want


def test_more_items_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 7)
    rng = random.Random(8)
    items = make_items(rng, 30, 30, 40)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(i, f"some words {x} and more") for i, x in items] + [(99, "clean text of no item at all")]
    assert len(decontam.build_blocks(bench)) > 2
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents(spark, rows), bench).collect()}
    assert {(i, i) for i, _ in items} <= got and all(d != 99 for d, _ in got)
    assert decontam.decontaminate(documents(spark, rows), bench).count() == 1


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contaminated(documents(spark, EDGES), bench).count() == 0
    assert decontam.decontaminate(documents(spark, EDGES), bench).count() == len(EDGES)
    assert decontam.contaminated(documents(spark, []), spark.createDataFrame([(1, "a b c d e f g")], "item_id bigint, text string")).count() == 0


def test_question_and_answer():
    q, a = decontam.question_answer("What is it that is asked here today? This is the answer that is looked for here.")
    assert q[-1] == "today" and a[0] == "this"
    q, a = decontam.question_answer("Short one? Yes.")
    assert q == a == ["short", "one", "yes"]
