import hashlib
import random

import numpy as np

from corpusmill.llm import suffix

from .helpers import EDGES, documents


def brute(docs, length):
    """[(id or None, bytes)] -> kept bytes, removed count and runs per document, in order."""
    first = {}
    for d, t in docs:
        for i in range(len(t) - length + 1):
            if d is not None:
                first[t[i:i + length]] = min(d, first.get(t[i:i + length], d))
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if d is not None and first[t[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        out.append((bytes(c for c, x in zip(t, gone) if not x), sum(gone),
                    sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))))
    return out


def check(spark, rows, length=50):
    df = documents(spark, rows)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.removals(df, length=length).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    docs = [(r[0], (r[1] or "").encode()) for r in rows]
    want = sorted(((d, len(t), n, s, hashlib.sha256(k).hexdigest()) for (d, t), (k, n, s) in zip(docs, brute(docs, length))),
                  key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert got == want


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = list(EDGES)
    for case, alphabet in enumerate(["a", "ab", "abcdefghij ", "é中a "]):
        pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(40, 260))) for _ in range(6)]
        for i in range(40):
            rows.append((1000 * (case + 1) + i, "".join(
                rng.choice(pool)[rng.randint(0, 30):] if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90)))
                for _ in range(rng.randint(0, 5)))))
    check(spark, rows)


def test_lengths_around_the_window(spark):
    t = "".join(chr(97 + i * 7 % 26) for i in range(300))
    check(spark, [(1, t), (2, t[10:59]), (3, t[10:60]), (4, "x" + t[10:61] + "y" + t[70:119]), (5, t[100:200] + t[150:250])])


def test_empty_table(spark):
    assert suffix.removals(documents(spark, [])).count() == 0


def test_transform_orders_suffixes():
    """Ranks follow the suffixes' order, and a step leads to the suffix that begins with the symbol."""
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 99, n, np.uint8)) for n in (70, 5, 0, 64, 33)]
    buf, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    order, symbol, before = suffix.transform(buf, sizes)
    slots = [s[i:] for s in strings for i in range(len(s) + 1)]
    where = [(k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)]
    ranked = [slots[i][:suffix.LENGTH] for i in order]
    assert ranked == sorted(ranked)
    for rank, slot in enumerate(order):
        k, i = where[slot]
        if i >= suffix.STEP:
            assert slots[order[before[rank]]] == strings[k][i - suffix.STEP:]
            assert int(symbol[rank]) == int.from_bytes(strings[k][i - suffix.STEP:i], "big")
        else:
            assert before[rank] == -1


def test_fingerprints_depend_on_the_window_alone():
    t = bytes(np.random.default_rng(2).integers(97, 123, 500, np.uint8))
    whole = suffix.window_prints(np.frombuffer(t, np.uint8))
    for i in (0, 17, 450):
        assert suffix.window_prints(np.frombuffer(t[i:i + 50], np.uint8))[0] == whole[i]


def test_long_text_is_cut_into_slices(monkeypatch):
    t = bytes(np.random.default_rng(3).integers(97, 123, 5000, np.uint8))
    monkeypatch.setattr(suffix, "SLICE", 512)
    windows = sorted(x for _, _, s, n in suffix.segments([t]) for a, c in zip(s, n) for x in range(a, a + c))
    assert windows == list(range(5000 - 49))


def test_more_groups_do_not_make_more_shards(monkeypatch):
    """Shards are cut by bytes: segments dealt to many groups take no more transforms, and get the same answers."""
    import pyarrow as pa
    rng = random.Random(8)
    base = bytes(np.random.default_rng(8).integers(97, 123, 400, np.uint8))
    strings = [bytes(rng.choices(range(97, 123), k=rng.randint(0, 20))) + base[(i := rng.randrange(300)):i + rng.randint(60, 100)] for _ in range(240)]
    least = np.array([rng.randrange(10**6) for _ in strings], np.int64)

    def table(groups):
        own = [range(g, len(strings), groups) for g in range(groups)]
        return pa.table({"g": pa.array(range(groups), pa.int64()), "bucket": pa.array([0] * groups, pa.int64()),
                         "bytes": pa.array([suffix.packed(b"".join(strings[i] for i in o)) for o in own], pa.binary()),
                         "sizes": pa.array([suffix.packed(np.array([len(strings[i]) for i in o], np.int32)) for o in own], pa.binary()),
                         "least": pa.array([suffix.packed(least[list(o)]) for o in own], pa.binary())})

    def answers(t, groups):
        out = {}
        for g, *cols in zip(*(t.column(c).to_pylist() for c in ("g", "counts", "from", "to", "owner"))):
            count, lo, hi, who = (suffix.unpacked(x, k).tolist() for x, k in zip(cols, (np.int32, np.int32, np.int32, np.int64)))
            at = 0
            for i, n in zip(range(g, len(strings), groups), count):
                out[i] = [w for x in range(at, at + n) for w in [who[x]] * (hi[x] - lo[x])]
                at += n
        return out
    made, real = [], suffix.transform
    monkeypatch.setattr(suffix, "transform", lambda *a: (made.append(1), real(*a))[1])
    few, n_few = answers(suffix.verdicts(table(2), 50), 2), len(made)
    many, n_many = answers(suffix.verdicts(table(120), 50), 120), len(made) - n_few
    first: dict = {}
    for s, w in zip(strings, least.tolist()):
        for i in range(len(s) - 49):
            first[s[i:i + 50]] = min(w, first.get(s[i:i + 50], w))
    assert few == many == {k: [first[s[i:i + 50]] for i in range(len(s) - 49)] for k, s in enumerate(strings)}
    assert n_many <= n_few + 1


def test_shared_prints_over_many_groups():
    """Of every group those fingerprints stay that it has in two documents or that another group has."""
    import pyarrow as pa
    rng = np.random.default_rng(9)
    prints = [np.unique(rng.integers(0, 3000, 12).astype(np.uint64)) for _ in range(300)]
    many = [rng.random(len(p)) < 0.1 for p in prints]
    t = pa.table({"g": pa.array(range(300), pa.int64()), "prints": pa.array([p.tobytes() for p in prints], pa.binary()),
                  "many": pa.array([np.packbits(m).tobytes() for m in many], pa.binary())})
    values, count = np.unique(np.concatenate(prints), return_counts=True)
    n = dict(zip(values.tolist(), count.tolist()))
    want = {g: [x for x, m in zip(p.tolist(), own) if m or n[x] > 1] for g, (p, own) in enumerate(zip(prints, many))}
    got = suffix.shared_prints(t)
    assert {g: np.frombuffer(p, np.uint64).tolist() for g, p in zip(got.column("g").to_pylist(), got.column("prints").to_pylist())} == {g: p for g, p in want.items() if p}
