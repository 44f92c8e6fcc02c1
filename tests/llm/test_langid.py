import zlib

import numpy as np

from corpusmill.llm import langid
from corpusmill.llm.common import table

from .helpers import EDGES, documents
from tests.conftest import SF001


def test_bundle_is_the_sum_of_bound_vectors():
    text = "Abc ab"
    codes, n = langid.trigrams(text)
    want = np.zeros(64)
    x = [langid.GAP] + [ord(c) if c != " " else langid.GAP for c in text.lower()] + [langid.GAP]
    for a, b, c in zip(x, x[1:], x[2:]):
        v = [langid.rolled(k, 64, 1)[2].astype(int) for k in (a, b, c)]
        want += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    assert np.array_equal(langid.bundle([(codes, n)], None, 64, 1)[0], want)
    assert n.sum() == len(x) - 2


def test_non_letters_are_one_gap():
    same = langid.trigrams("ab cd")
    for t in ("AB 12\ncd", "  ab,.! cd??", "ab\tcd "):
        assert all(np.array_equal(a, b) for a, b in zip(langid.trigrams(t), same))
    assert langid.trigrams(None) is None and langid.trigrams("") is None and langid.trigrams("12 !!") is None


def test_held_out_accuracy(spark):
    docs = table(spark, SF001, "documents")
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_edges(spark):
    got = {r["doc_id"]: r for r in langid.identify_languages(documents(spark, EDGES)).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4, 8))
    assert got[7]["lang_pred"] != "und" and got[5]["lang_pred"] == "en"
    assert langid.identify_languages(documents(spark, [])).count() == 0
    nothing = langid.identify_languages(documents(spark, [(1, "abc def", None)])).collect()
    assert nothing[0]["lang_pred"] == "und"
