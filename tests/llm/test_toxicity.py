import random
import zlib

import numpy as np

from corpusmill.llm import toxicity
from corpusmill.llm.common import table

from .helpers import EDGES, documents
from tests.conftest import SF001


def maximal(scores):
    """All maximal scoring subsequences by definition: the best one, then left and right of it."""
    def best(lo, hi):
        top = max(((sum(scores[i:j]), i - j, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
        if top is None or top[0] <= 0:
            return []
        _, _, i, j = top
        return best(lo, i) + [(i, j)] + best(j, hi)
    return best(0, len(scores))


def test_segments_equal_their_definition():
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(s))
        assert [(a, b) for a, b, _ in got] == maximal(s)
        for a, b, x in got:
            assert abs(x - sum(s[a:b])) < 1e-9


def test_held_out_documents(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r, y[i]) for i, r in got.items() if r["held_out"] and i in y]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
               and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    assert sum(r["predicted"] == 1 for r, t in held if t == 0) <= 2
    assert sum(r["predicted"] == 1 for r, t in held if t == 1) >= 0.6 * sum(t for _, t in held)


def test_passage_in_a_long_clean_document(spark):
    rng = random.Random(1)
    clean = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    rows, labels = [], []
    for i in range(300):
        w = clean(80)
        if i % 5 == 0:
            for k in range(20, 28, 2):
                w[k] = f"vile{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 5 == 0)))
    long = clean(4000)
    long[2000:2008] = ["vilexx", "w1", "vileyy", "vile7", "w2", "vile8", "vile9", "vile1"]       # unseen words too
    rows += [(1000, " ".join(long)), (1001, " ".join(clean(4000)))]
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == 0
    p = max(got[1000]["passages"], key=lambda x: x["end"] - x["start"])
    assert (p["start"], p["end"]) == (2000, 2008)


def test_copies_count_once(spark):
    rows = [(i, "one two three four five six seven eight") for i in range(20)] + [(50, "other words stand here in this very text")]
    known = spark.createDataFrame([(i, 1) for i in range(20)] + [(50, 1)], "cm_label_id bigint, cm_toxic int")
    assert sorted(r[0] for r in toxicity.without_copies(documents(spark, rows), known, "doc_id", "text").select("cm_label_id").collect()) == [0, 50]


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 1, None), (None, 1, 1), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, EDGES), labels).collect()
    assert len(got) == len(EDGES) and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    assert toxicity.toxicity(documents(spark, []), labels).count() == 0
    assert toxicity.toxicity(documents(spark, EDGES), labels.where("false")).count() == len(EDGES)


def test_a_common_passage_makes_no_copy(spark):
    """Training rows go only if they are alike as a whole: not for a passage, be it half of the text."""
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(60))) for i in range(40)]
    long = " ".join(f"long{i}" for i in range(200))
    rows += [(100, long), (101, long + " end"), (102, long.upper() + "!"), (103, None), (104, ""), (105, " . ")]
    docs = documents(spark, rows)
    known = spark.createDataFrame([(r[0], 0) for r in rows], "cm_label_id bigint, cm_toxic int")
    got = {r["cm_label_id"] for r in toxicity.without_copies(docs, known, "doc_id", "text").collect()}
    assert got == set(range(40)) | {100, 104}
