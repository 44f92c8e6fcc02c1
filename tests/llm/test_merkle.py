import hashlib
import random
import zlib

from corpusmill.llm import merkle

from .helpers import EDGES, documents


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """(root, per node its steps): the tree over ``nodes`` and every node's siblings, by recursion."""
    if len(nodes) <= 1:
        return nodes[0], [[] for _ in nodes]
    runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
    root, above = climb([sha("".join(r)) for r in runs], fanout)
    return root, [[("".join(r[:k]), "".join(r[k + 1:]))] + above[j] for j, r in enumerate(runs) for k in range(len(r))]


def brute(rows, fanout):
    """rows: (doc_id, text, lang, source, n_chars)."""
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    sources: dict = {}
    for i, t, lang, src, n in rows:
        own = leaf((i, src, lang, n, t))
        hit = i is not None and zlib.crc32(str(i).encode()) % 5 == 0 and t is not None
        sources.setdefault(src, []).append((i is not None, i or 0, own, leaf((i, src, lang, n, t.translate(lower))) if hit else own, i))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s])], fanout) for s in order}
    root, tops = climb([trees[s][0] for s in order], fanout) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for x, steps in zip(sorted(sources[s]), trees[s][1]):
            path, h = steps + top, x[3]
            for a, b in path:
                h = sha(a + h + b)
            out.append((x[4], x[2], trees[s][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def check(spark, rows, fanout=16):
    df = documents(spark, rows)
    full = [(*(tuple(r) + (None,) * (4 - len(r))), None if r[1] is None else len(r[1])) for r in rows]
    got = sorted((tuple(r) for r in merkle.proofs(df, fanout=fanout).collect()), key=repr)
    assert got == brute(full, fanout)
    return got


def test_against_recursion(spark):
    """A source with a third of all rows, sources of 1, 16 and 17 rows, a null source; several levels."""
    rng = random.Random(4)
    rows = [(i, f"Text {rng.random()}", "en", "hot" if i % 3 == 0 else f"s{i % 23}") for i in range(900)]
    rows += [(2000 + i, f"T{i}", None, "sixteen") for i in range(16)] + [(3000 + i, f"T{i}", None, "seventeen") for i in range(17)]
    rows += [(5000, "Alone", "de", "one"), (5001, None, None, None), (5002, "no source", "en", None)]
    rng.shuffle(rows)
    got = check(spark, rows)
    assert {r[-1] for r in got} == {True, False}


def test_every_tamper_that_changes_a_text_shows(spark):
    rows = [(i, "UPPER" if i % 2 else "lower", "en", f"s{i % 3}") for i in range(200)]
    for r in check(spark, rows, fanout=4):
        changed = zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[0] % 2
        assert r[-1] == (not changed)


def test_repeated_rows_and_ids(spark):
    check(spark, [(1, "A", "en", "a")] * 40 + [(1, "B", "en", "a"), (None, "C", "en", "a"), (None, None, None, None)], fanout=4)


def test_edges(spark):
    check(spark, EDGES)
    check(spark, EDGES[:1])
    check(spark, [(i, "x", "en", "only") for i in range(3)])
    assert merkle.proofs(documents(spark, [])).count() == 0
