import random
import re

import numpy as np
import xxhash

from corpusmill.llm import simhash
from corpusmill.llm.graph import components

from .helpers import EDGES, collected, documents


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, bits):
    label = dict(enumerate(ids))
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        if label[i] is not None:
            least[find(i)] = min(least.get(find(i), label[i]), label[i])
    return [least.get(find(i)) for i in range(len(ids))]


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 120))] for _ in range(25)]
    rows = list(EDGES)
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(400)}"
        rows.append((100 + i, rng.choice([" ", "\t", "  \n"]).join(w).title()))
    got = collected(simhash.near_duplicates(documents(spark, rows)), "doc_id", "fingerprint")
    prints = [brute_print(r[1]) for r in rows]
    want = sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, brute_components(prints, [r[0] for r in rows], 2))),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got] == [tuple(r) for r in want]


def test_pigeonring_loses_no_link():
    """Whatever bits differ, some start of the ring has all its chains within budget."""
    rng = np.random.default_rng(0)
    for segments, bits in ((16, 2), (8, 3), (4, 2), (16, 0)):
        for _ in range(300):
            x = 0
            for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
                x |= 1 << int(b)
            w = 64 // segments
            rot = [np.uint64(((x >> (i * w)) | (x << (64 - i * w))) & (2**64 - 1)) for i in range(segments)]
            assert any(simhash.viable(np.array([r]), segments, bits)[0] for r in rot)
    far = np.array([np.uint64(0b111)])
    assert not simhash.viable(far, 16, 2)[0]


def test_links_of_a_family_stay_linear(spark):
    """One family of near copies: 64 single-bit neighbours of zero are all within two bits of one another."""
    df = spark.createDataFrame([(1 << b if b < 63 else -(1 << 63),) for b in range(64)] + [(0,)], "fp bigint")
    edges = simhash.links(df)
    assert edges.count() <= 16 * 65
    comp = components(edges)
    assert comp.select("root").distinct().count() == 1 and comp.count() == 65


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(500)]
    star = [(1000, 1001 + i) for i in range(300)]
    noise = [(5, 5), (None, 3), (3, None), (1, 0), (1, 0)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(chain + star + noise, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(501)}, **{1000 + i: 1000 for i in range(301)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table_and_keep_one(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    rows = [(3, "a b c d e"), (9, "A b c d e"), (4, "x y z u v w q"), (5, None), (6, ""), (7, "  ")]
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
    rows = [(3, "a b c"), (3, "a b c"), (8, "a b c"), (None, "q r s t"), (None, "q r s t")]
    assert sorted((r["doc_id"] is None, r["text"]) for r in simhash.keep_one(documents(spark, rows)).collect()) == [(False, "a b c"), (True, "q r s t")]


def test_rows_without_or_with_a_repeated_id_go_by_their_fingerprint(spark):
    """Of a group one row stays, whatever its ids: the smallest known one, else any; equal rows are told apart too."""
    near = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, near)] * 3 + [(7, near), (9, near)]                   # null ids beside known ones
    rows += [(None, "alpha beta gamma")] * 2 + [(None, "ALPHA beta gamma"), (None, "delta epsilon zeta eta")]
    rows += [(20, "red green blue"), (20, "red green blue"), (20, "quite another text here"), (21, "quite another text here")]
    rows += [(19, "quite another text here")]
    for parts in (1, 5):
        kept = sorted((r["doc_id"] or 0, r["text"].lower()) for r in simhash.keep_one(documents(spark, rows).repartition(parts)).collect())
        assert kept == [(0, "alpha beta gamma"), (0, "delta epsilon zeta eta"), (7, near), (19, "quite another text here"), (20, "red green blue")]
