import random
import re
from collections import Counter

from corpusmill.llm import collocations as C

from .helpers import EDGES, documents


def brute(rows, min_count, top, max_words=5):
    """rows: (text, lang).  All n-grams counted, all longer candidates compared."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f: dict = {}
    for t, lang in rows:
        count = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, max_words + 1):
                count.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for g, c in count.items() if len(g) == 1)
        cand = {g: c for g, c in count.items() if len(g) > 1 and c >= min_count}
        covered = {}
        for g, c in cand.items():
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g):
                        covered[g[i:j]] = max(covered.get(g[i:j], 0), c)
        rank = []
        for g, a in cand.items():
            if covered.get(g, 0) < a:
                cuts = [(1000 * a * n // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                rank.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rank)[:top], 1)]
    return sorted(out)


def got(spark, rows, **kw):
    df = documents(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)]).repartition(3)
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def corpus(seed):
    """Zipfian words in two languages, a passage that many texts share, texts that repeat, loops of one word."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "|", "x\x00y", "-", "Wü"]
    weight = [1 / (i + 1) for i in range(len(words))]
    passage = "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda. Mu"
    out = []
    for i in range(400):
        body = " ".join(x + rng.choice(["", "", "", ",", ".", "\t", "\n", "; :"]) for x in rng.choices(words, weight, k=40))
        out.append((body + (" " + passage if i % 7 == 0 else ""), rng.choice(["en", "en", "de", None])))
    out += out[:15] * 3 + [("loop " * 30, "de"), ("", "en"), (None, None), (" .,; ", "fr"), ("Lone", "es")]
    return out


def test_against_all_ngrams(spark):
    rows = corpus(1)
    for top in (5, 40, 2000):
        assert got(spark, rows, min_count=6, top=top) == brute(rows, 6, top), top


def test_the_frontier_is_not_expanded_where_its_bound_is_low(spark, monkeypatch):
    """The first batches settle a small top; the results are those of the full expansion."""
    rows = corpus(2)
    calls = []
    plain = C._expand
    monkeypatch.setattr(C, "_expand", lambda *a: (calls.append(1), plain(*a))[1])
    assert got(spark, rows, min_count=4, top=3) == brute(rows, 4, 3)
    few = len(calls)
    assert got(spark, rows, min_count=4, top=2000) == brute(rows, 4, 2000)
    assert few < len(calls) - few


def test_ties_at_the_last_place_go_by_phrase(spark):
    rows = [(f"a{i} b{i}", "en") for i in range(30)] * 4
    assert got(spark, rows, min_count=4, top=7) == brute(rows, 4, 7)


def test_exact_where_products_pass_64_bits(spark):
    df = spark.createDataFrame([(10**12, 10**13, 10**12 + 1, 10**12 + 7)], "a bigint, n bigint, l bigint, r bigint")
    a, n, left, right = df.first()
    assert df.select(C._score(df.a, df.n, df.l, df.r)).first()[0] == 1000 * a * n // (left * right)


def test_edges(spark):
    rows = [(r[1], r[2] if len(r) > 2 else None) for r in EDGES]
    assert got(spark, rows, min_count=2, top=50) == brute(rows, 2, 50)
    assert C.collocations(documents(spark, [])).count() == 0


def test_a_word_is_named_once_however_many_tasks_note_it(spark):
    rows = [(f"common words and w{i}", "en") for i in range(40)]
    df = documents(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)]).repartition(4)
    named = C.names_of(C.encoded(df, "text", "lang", 42), lambda h: h == h, 42)
    got = Counter(bytes(r["w"]).decode() for r in named.collect())
    assert got == Counter(["common", "words", "and", *(f"w{i}" for i in range(40))])


def test_only_words_of_the_result_are_named(spark, monkeypatch):
    """What tasks send to be named goes with the result, not with the frequent words each of them has met."""
    rng = random.Random(3)
    rows = [(" ".join(rng.choices([f"w{k}" for k in range(50)], k=20)) + (" best pair" if i % 10 == 0 else ""), "en") for i in range(200)]
    named, plain = [], C.names_of
    monkeypatch.setattr(C, "names_of", lambda *a: (named.append(plain(*a)), named[-1])[1])
    out = got(spark, rows, min_count=5, top=2)
    assert out == brute(rows, 5, 2)
    told = {bytes(r["w"]).decode() for n in named for r in n.collect()}
    candidates = {w for r in brute(rows, 5, 2000) if r[7] >= out[-1][7] for w in r[2].split()}
    assert {w for r in out for w in r[2].split()} <= told <= candidates
    assert len(told) < 50
