import re

from pyspark.sql import functions as F

from corpusmill.operators import clean, dedup


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id bigint, text string")


def test_normalize_and_control(spark):
    dirty = "  Hello\t\tworld \r\nline\x00two\x07\r\n\r\n\r\n\r\nend   "
    out = clean.normalize_text(clean.strip_control(one(spark, dirty))).collect()[0]["text"]
    assert out == "Hello world\nlinetwo\n\nend"


def test_length_filter(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "word " * 60)], "doc_id bigint, text string")
    kept = [r["doc_id"] for r in clean.length_filter(df, min_chars=10, max_chars=1000, min_words=50).collect()]
    assert kept == [2]


def test_exact_dedup_case_space_variants(spark):
    df = spark.createDataFrame([(5, "Hello  World"), (3, "hello world "), (9, " HELLO\nworld"), (4, "other")],
                               "doc_id bigint, text string")
    kept = sorted(r["doc_id"] for r in dedup.exact_dedup(df).collect())
    assert kept == [3, 4]


def test_pii_and_secret(spark):
    t = 'mail a.b@x.example.com call +1 (555) 123-4567 ip 10.0.0.1 card 4111111111111111 token = "' + "ab" * 20 + '"'
    r = clean.secret_redact(clean.pii_redact(one(spark, t))).collect()[0]
    assert r["text"] == "mail <EMAIL> call <PHONE> ip <IP> card <CARD> <SECRET>"
    assert (r["n_email"], r["n_phone"], r["n_ip"], r["n_card"], r["n_secret"]) == (1, 1, 1, 1, 1)
    assert "<SECRET>" in r["text"] and "<EMAIL>" in r["text"] and "<CARD>" in r["text"]


def test_license_strip(spark):
    t = "keep me\nCopyright 2020 Someone\nLicensed under the MIT License.\nalso keep"
    assert clean.license_strip(one(spark, t)).collect()[0]["text"] == "keep me\nalso keep"


def test_line_dedup(spark):
    boiler = "subscribe to our newsletter today"
    rows = [(i, f"unique line {i} here\n{boiler}\nshort") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in clean.line_dedup(df, min_words=3, min_docs=10).collect()}
    assert out[0] == "unique line 0 here\nshort"
    joined = {r["doc_id"]: r["text"] for r in clean.line_dedup(df, min_words=3, min_docs=10,
                                                                max_inline_keys=0).collect()}
    assert joined == out


def test_quality_reason_order(spark):
    df = spark.createDataFrame([(1, "### ### ### ###"), (2, "the cat sat on the mat " * 5)], "doc_id bigint, text string")
    r = {x["doc_id"]: x for x in clean.quality_filter(clean.quality_stats(df)).collect()}
    assert r[1]["reason"] == "alpha" and not r[1]["keep"]
    assert r[2]["keep"]


def test_funnel_reconciles(spark):
    from corpusmill.plans.registry import docs, funnel_stages
    d = docs(spark, "/root/testdata/sf0.001")
    f = clean.clean_funnel(funnel_stages(d)).where(F.col("lang").isNull()).orderBy("rows", ascending=False).collect()
    rows = [r["rows"] for r in f]
    assert rows[0] == d.count()
    assert sum(r["dropped"] for r in f) == rows[0] - rows[-1]


def test_user_rules(spark):
    import pandas as pd

    @F.pandas_udf("boolean")
    def no_digits(s: pd.Series) -> pd.Series:
        return ~s.str.contains("[0-9]")
    df = spark.createDataFrame([(1, "plain words"), (2, "has 1 digit"), (3, "x")], "doc_id bigint, text string")
    out = {r["doc_id"]: r["reason"] for r in clean.apply_rules(
        df, [("short", lambda t: F.length(t) > 3), ("digits", no_digits)]).collect()}
    assert out == {1: "ok", 2: "digits", 3: "short"}


def test_decontaminate_both_join_paths_equal_brute_force(spark):
    from corpusmill.operators.decontam import decontaminate
    from corpusmill.sources.corpus import table
    d = table(spark, "/root/testdata/sf0.001", "documents")
    b = table(spark, "/root/testdata/sf0.001", "benchmark")
    broadcast = sorted(map(tuple, decontaminate(d, b).collect()))
    shuffled = sorted(map(tuple, decontaminate(d, b, max_broadcast_rows=0).collect()))

    def grams(t):
        w = [x for x in re.split("[ \t\n\r]+", t.lower()) if x]
        return {tuple(w[i:i + 13]) for i in range(len(w) - 12)}
    items = [grams(r["text"]) for r in b.collect()]
    want = sorted((r["doc_id"], any(n := [bool(grams(r["text"]) & i) for i in items]), sum(n)) for r in d.collect())
    assert broadcast == shuffled == want and any(r[1] for r in want)
