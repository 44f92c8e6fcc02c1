import hashlib
import random
import re

from corpusmill.llm import pii

from .helpers import EDGES, documents

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
                if not 16 <= len(d) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_patterns_equal_plain_matching():
    rng = random.Random(6)
    fixed = ["a@b.c@d.e", "x@y", "@a.b", "é.a@b.co.uk.", "1.2.3.4.5.6.7.8", "1.2.3.256.1.2.3", "0001.2.3.000255", "999.1.1.1.1", "+1 (212) 555-1234.", "+", "+1", "++12345678",
             "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111111111111111", "a.b.c@d-.e", "1..2.3.4", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", None, ""]
    for t in fixed + ["".join(rng.choice("01234.5 -+()@ab") for _ in range(rng.randint(1, 60))) for _ in range(4000)]:
        assert pii.base_spans(t) == brute(t), t


def test_long_runs_are_linear():
    for t in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 100_000, "+1" + " " * 100_000, "1 " * 100_000):
        pii.base_spans(t)


def private(spark):
    rows = []
    for i in range(12):                      # a name that only ever stands beside one address
        rows.append((i, f"filler{i} words{i} before Quentarius writes from quentarius@mail.example.com about the weather number{i} today"))
    for i in range(12, 200):
        rows.append((i, f"about the weather and words{i} that writes from before the today filler{i}"))
    rows.append((300, "quentarius is not named elsewhere? call +1 (212) 555-1234 or 10.0.0.1"))
    return rows


def test_terms_that_give_an_entity_away(spark):
    rows = private(spark)
    df = documents(spark, rows)
    got = {r["doc_id"]: r for r in pii.span_rows(pii.private_spans(df)).collect()}
    text = dict(rows)
    for i in range(12):
        spans = [x.split(":") for x in got[i]["spans"].split(",")]
        assert spans[0][0] == "email" and got[i]["n_email"] == 1
        terms = [text[i][int(a):int(b)] for k, a, b in spans if k == "term"]
        assert terms == ["Quentarius"]                     # common words and chance neighbours stay
        assert got[i]["base_sha256"] == hashlib.sha256(":".join(spans[0]).encode()).hexdigest()
    assert got[50]["spans"] == "" and got[50]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    out = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert len(out) == len(rows) and out[50] == text[50]
    assert "uentarius" not in out[3] and "[EMAIL]" in out[3] and "weather" in out[3]
    # In a document without its entity the term gives it away just as well.
    assert out[300] == " is not named elsewhere? call [PHONE] or [IP]"


def test_disclosure_is_the_share_of_information(spark):
    """PMI over IC from the definition, for every pair above the support."""
    import math
    rows = [(i, f"alpha w{i} x{i} y{i} a@b.cd beta z{i} u{i} v{i}" if i < 16 else "beta" if i < 32 else "gamma") for i in range(128)]
    df = documents(spark, rows)
    found = pii.scan(df)
    flagged = {r["t"]: r["share"] for r in pii.disclosing(found, df, generalise=0.1).collect()}
    assert abs(flagged["alpha"] - 1.0) < 1e-12             # alpha never stands alone
    assert abs(flagged["beta"] - math.log2(16 * 128 / (32 * 16)) / math.log2(128 / 16)) < 1e-12


def test_terms_are_taken_out_wherever_they_stand(spark):
    """More than a context away from the entity, and in documents that do not hold it; counted over whole documents."""
    gap = lambda i: " ".join(f"weather w{i}x{k}" for k in range(15))  # noqa: E731 - texts that are no copies of one another
    rows = [(i, f"Quentarius {gap(i)} quentarius@mail.example.com {gap(i + 50)} quentarius filler{i}") for i in range(12)]
    rows += [(i, f"about the weather today filler{i}") for i in range(12, 200)]
    rows += [(300, "QUENTARIUS is named, weather, quentarius"), (301, "mail example com"), (None, "of quentarius")]
    df = documents(spark, rows)
    got = {r["doc_id"]: [(x["s"], x["x"], x["level"]) for x in r["terms"]] for r in pii.private_spans(df).collect()}
    assert got[300] == [(0, 10, 2), (30, 40, 2)] and got[None] == [(3, 13, 2)]
    assert got[301] == got[50] == []                       # parts of an address are no terms beside it
    assert all(len(got[i]) == 2 for i in range(12))
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert out[300] == " is named, weather, " and out[None] == "of " and out[50] == dict(rows)[50]
    assert not any("uentarius" in t.lower() for t in out.values())


def test_copies_are_no_evidence(spark):
    """A text with an address, copied and nearly copied: none of its words discloses anything, no other document is touched."""
    base = [f"rare{i}" if i % 2 else f"common{i % 10}" for i in range(120)]
    rows = [(i, " ".join(base[:60] + ["someone@mail.example.com"] + base[60:])) for i in range(4)]
    for i in range(4, 12):
        w = list(base)
        w[(i * 7) % 120] = f"edit{i}"
        rows.append((i, " ".join(w[:60] + ["Someone@mail.example.com"] + w[60:])))
    rows += [(100 + i, f"rare{i % 60} common{i % 10} own{i}") for i in range(200)]
    df = documents(spark, rows)
    assert pii.disclosing(pii.scan(df), df).count() == 0
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert all(out[i] == t for i, t in rows if i >= 100)
    assert all(out[i] == re.sub("[Ss]omeone@mail.example.com", "[EMAIL]", t) for i, t in rows if i < 100)


def test_a_term_among_copies_is_found_by_its_independent_documents(spark):
    rows = private(spark)
    rows += [(1000 + k * 100 + i, t) for k in range(3) for i, t in rows[:12]]
    got = pii.span_rows(pii.private_spans(documents(spark, rows))).collect()
    assert all(r["n_terms"] == 1 for r in got if r["n_email"])


def test_edges(spark):
    got = pii.span_rows(pii.private_spans(documents(spark, EDGES))).collect()
    assert len(got) == len(EDGES) and all(r["spans"] == "" for r in got)
    assert pii.private_spans(documents(spark, [])).count() == 0
    out = pii.sanitise(documents(spark, EDGES)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out if r["doc_id"] is not None and r["text"] is not None) == \
        sorted((r[0], r[1]) for r in EDGES if r[0] is not None and r[1] is not None)
    assert pii.sanitise(documents(spark, [])).count() == 0
