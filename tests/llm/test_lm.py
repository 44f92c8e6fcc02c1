import random
import zlib
from collections import Counter

import numpy as np

from corpusmill.llm import lm

from .helpers import EDGES, documents


def test_conditionals_are_distributions():
    """Over all tokens the probabilities at a position add up to one."""
    p = lm.initial(np.arange(1, lm.TOKENS + 1, dtype=float))
    ids = np.array([lm.PAD, lm.PAD, 5, 0, 9, lm.PAD, lm.PAD])
    total = 0.0
    for w in range(lm.TOKENS):
        ids[3] = w
        total += float(np.exp(lm.log_probs(p, lm.scaled(p), ids, np.array([3]))[0]))
    assert abs(total - 1) < 1e-3


def test_step_follows_the_gradient():
    rng = np.random.default_rng(0)
    p = {k: v for k, v in lm.initial(np.ones(lm.TOKENS)).items()}
    seqs = [rng.integers(0, 40, 30) for _ in range(20)]
    ids, at, _ = lm.padded(seqs)
    t = lm.Trainer(p)
    before = lm.log_probs(t.p, lm.scaled(t.p), ids, at).mean()
    for _ in range(30):
        t.step(ids, at)
    assert lm.log_probs(t.p, lm.scaled(t.p), ids, at).mean() > before + 1


def test_vocabulary_counts_the_whole_corpus(spark):
    rows = list(EDGES) + [(100 + i, f"Common word{i}") for i in range(50)]
    vocab, counts, log_types = lm.vocabulary(documents(spark, rows))
    want = Counter(w for r in rows if r[1] for w in r[1].lower().split())
    assert counts.sum() == sum(want.values()) and counts[vocab["common"]] == 50
    out = [w for w in want if w not in vocab]
    types = Counter(zlib.crc32(w.encode()) % lm.BUCKETS for w in out)
    assert all(abs(log_types[b] - np.log(max(types[b], 1))) < 1e-12 for b in range(lm.BUCKETS))


def test_scores(spark):
    """A document's score is the sum over its tokens, each predicted from both sides, and order matters."""
    rng = random.Random(0)
    sentence = lambda: " ".join(rng.choice([["red", "apple", "falls"], ["blue", "river", "runs"]])[k] for _ in range(1) for k in range(3))
    rows = [(100 + i, " ".join(sentence() for _ in range(40))) for i in range(150)]
    plain = "red apple falls blue river runs " * 20
    mixed = plain.split()
    random.Random(1).shuffle(mixed)
    rows += [(1000, plain), (1001, " ".join(mixed))] + EDGES
    got = lm.pseudo_likelihood(documents(spark, rows), rounds=4).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["log_likelihood"] > by[1001]["log_likelihood"] + 50
    for i in (2, 3, 4):
        assert by[i]["n_tokens"] == 0 and by[i]["log_likelihood"] == 0 and by[i]["mean_log_likelihood"] is None
    assert by[5]["n_tokens"] == 30_000
    for r in got:
        if r["n_tokens"]:
            assert abs(r["mean_log_likelihood"] - r["log_likelihood"] / r["n_tokens"]) < 1e-9 and r["log_likelihood"] < 0
    assert lm.pseudo_likelihood(documents(spark, [])).count() == 0


def test_every_position_is_trained_on(spark):
    """Token 1 stands only where the hash of the position is 2 to 7; the registered number of rounds learns it."""
    _, at, _ = lm.padded([np.zeros(4000, np.int16)])
    ids = ((at * 2654435761 >> 7) % lm.MASK >= 2).astype(np.int16)
    encoded = spark.createDataFrame([(1, bytearray(ids.tobytes()))], "doc_id bigint, ids binary").coalesce(1)
    p = lm.train(encoded, np.ones(lm.TOKENS))
    assert ids.mean() > 0.7 and p["low_b"][0][1] > p["low_b"][0][0]
    for rounds in (1, 2, 3, 4, 8):
        told = np.concatenate([x for r in range(rounds) for x in lm.hidden(at, r, rounds)])
        assert sorted(told.tolist()) == at.tolist()


def test_padding_keeps_documents_apart():
    ids, at, sizes = lm.padded([np.array([1, 2]), np.array([], np.int64), np.array([3])])
    assert sizes.tolist() == [2, 0, 1] and ids[at].tolist() == [1, 2, 3]
    assert (ids == lm.PAD).sum() == lm.WINDOW * 4 and (np.diff(at) > 0).all() and at[2] - at[1] > lm.WINDOW


def plain_score(p, ids, log_types):
    """The definition: per position a softmax over all classes, one over all tokens of the token's class, from its neighbours alone."""
    total, first = 0.0, lm.TOKENS - lm.BUCKETS
    around = lambda i: ids[i] if 0 <= i < len(ids) else lm.PAD
    q = {k: v.astype(np.float64) for k, v in p.items()}
    for i, t in enumerate(ids):
        h = np.tanh(sum(q["place"][k] * q["emb"][around(i + o)] for k, o in enumerate(lm.OFFSETS)) + q["bias"])
        for x, at in ((q["top"] @ h + q["top_b"], t // lm.CLASS), (q["low"][t // lm.CLASS] @ h + q["low_b"][t // lm.CLASS], t % lm.CLASS)):
            total += x[at] - np.log(np.exp(x).sum())
        if t >= first:
            total -= log_types[t - first]
    return total


def test_the_query_equals_a_plain_loop(spark):
    """Vocabulary, ids and summed conditional log-probabilities of every row, from the trained parameters by the definition."""
    rng = random.Random(7)
    rows = [(100 + i, " ".join(f"w{rng.choice([rng.randrange(9), rng.randrange(9000)])}" for _ in range(rng.randint(0, 120)))) for i in range(200)]
    rows += [r for r in EDGES if r[0] != 5]
    df = documents(spark, rows).coalesce(1)
    got = lm.pseudo_likelihood(df).collect()
    vocab, counts, log_types = lm.vocabulary(df)
    p = lm.train(lm.encode(df, vocab).coalesce(1), counts)
    want = {}
    for r in rows:
        ids = [vocab.get(w, lm.TOKENS - lm.BUCKETS + zlib.crc32(w.encode()) % lm.BUCKETS) for w in (r[1] or "").lower().split()]
        want.setdefault(r[0], []).append((len(ids), plain_score(p, ids, log_types)))
    assert len(vocab) < len({w for r in rows for w in (r[1] or "").lower().split()})     # some words are in buckets
    assert len(got) == len(rows)
    for r in got:
        assert any(r["n_tokens"] == n and abs(r["log_likelihood"] - x) < 1e-3 * max(n, 1) for n, x in want[r["doc_id"]])


def test_softmax_is_in_place_and_rows_of_a_table_may_be_one_or_several():
    rng = np.random.default_rng(3)
    x, bias = rng.normal(size=(5, 7)).astype(np.float32), rng.normal(size=7).astype(np.float32)
    e = np.exp(x + bias)
    want = e / e.sum(1, keepdims=True)
    y = lm.softmax(x, bias)
    assert y is x and np.allclose(y, want, atol=1e-6)
    p = lm.initial(np.ones(lm.TOKENS))
    one, several = lm.Trainer(p), lm.Trainer(p)
    grad = rng.normal(size=(2, *p["low"][0].shape)).astype(np.float32)
    for _ in range(2):
        several.apply("low", grad, np.array([4, 9]))
        one.apply("low", grad[0], 4)
        one.apply("low", grad[1], 9)
    assert np.array_equal(one.p["low"], several.p["low"]) and np.array_equal(one.seen["low"], several.seen["low"])


def test_a_step_updates_each_parameter_once(monkeypatch):
    """Classes without a target in the step stay as they are; the others move as if updated one by one."""
    rng = np.random.default_rng(5)
    ids = np.concatenate([[lm.PAD] * lm.WINDOW, rng.integers(0, 10 * lm.CLASS, 500), [lm.PAD] * lm.WINDOW])
    at = np.arange(lm.WINDOW, len(ids) - lm.WINDOW)
    p = lm.initial(np.bincount(ids[at], minlength=lm.TOKENS).astype(float))
    t, calls, plain = lm.Trainer(p), [], lm.Trainer.apply
    monkeypatch.setattr(lm.Trainer, "apply", lambda self, name, *a: (calls.append(name), plain(self, name, *a))[1])
    t.step(ids, at)
    assert sorted(calls) == sorted(lm.SHAPES)
    there = np.unique(ids[at] // lm.CLASS)
    gone = np.setdiff1d(np.arange(lm.CLASS), there)
    for name in ("low", "low_b"):
        assert np.array_equal(t.p[name][gone], p[name][gone])
        assert all((t.p[name][k] != p[name][k]).any() for k in there)


def plain_step(p, ids, at):
    """The parameters after one Adagrad step from new, a position at a time."""
    q = {k: v.astype(np.float64) for k, v in p.items()}
    g = {k: np.zeros(v.shape) for k, v in q.items()}
    for i in at:
        near = [ids[i + o] for o in lm.OFFSETS]
        h = np.tanh(sum(q["place"][k] * q["emb"][w] for k, w in enumerate(near)) + q["bias"])
        c, t = divmod(ids[i], lm.CLASS)
        dh = 0
        for w, b, gw, gb, own in ((q["top"], q["top_b"], g["top"], g["top_b"], c), (q["low"][c], q["low_b"][c], g["low"][c], g["low_b"][c], t)):
            y = np.exp(w @ h + b)
            y /= y.sum()
            y[own] -= 1
            dh = dh + y @ w
            gw += np.outer(y, h)
            gb += y
        d = dh * (1 - h * h)
        g["bias"] += d
        for k, w in enumerate(near):
            g["place"][k] += d * q["emb"][w]
            g["emb"][w] += d * q["place"][k]
    return {k: q[k] - lm.RATE * g[k] / len(at) / np.sqrt(1e-8 + (g[k] / len(at)) ** 2) for k in q}


def test_a_step_works_in_pieces_and_equals_a_plain_loop(monkeypatch):
    """Runs of positions, single ones, gaps and document ends; no more than a piece of logits is there at a time, however large they are."""
    rng = np.random.default_rng(11)
    monkeypatch.setattr(lm, "PIECE", 16)
    ids, at, _ = lm.padded([rng.integers(0, 3 * lm.CLASS, k) for k in (90, 1, 0, 7, 60)])
    at = at[(np.arange(len(at)) < 40) | (rng.random(len(at)) < 0.4)]
    rows, plain = [], lm.softmax
    monkeypatch.setattr(lm, "softmax", lambda x, *a: (rows.append((len(x), *a[1:])), plain(x, *a))[1])
    for scale in (1, 300):
        p = lm.initial(np.bincount(ids[at], minlength=lm.TOKENS).astype(float))
        p["emb"] *= 10
        p["top"] *= scale
        rows.clear()
        t = lm.Trainer(p)
        t.step(ids, at)
        want = plain_step(p, ids, at)
        for k in p:
            assert np.abs(t.p[k] - want[k]).max() < 2e-3, k
        assert max(n for n, _ in rows) <= lm.PIECE and {w for _, w in rows} == {False, scale > 1}
    assert lm.largest(np.full((2, 3), -2.0), np.array([1.0, -1.5])) == 7.5


def test_ids_of_words_stay_bounded(monkeypatch):
    monkeypatch.setattr(lm, "COUNTER", 5)
    vocab = {"a": 0, "b": 1}
    ids = lm.Ids(vocab)
    for w in ["a", *(f"w{i}" for i in range(20)), "b", "w3", "a"]:
        assert ids[w] == vocab.get(w, lm.TOKENS - lm.BUCKETS + zlib.crc32(w.encode()) % lm.BUCKETS)
        assert len(ids) <= len(vocab) + 5
