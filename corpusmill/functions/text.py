"""Column expressions shared by the operators.

Every pattern is written so that Java regex (Spark) and RE2 (DuckDB, the
oracle) read it the same way: explicit character classes, no look-around,
no ``\\b``/``\\s``/``\\w`` (their Unicode meaning differs between the two).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (our own choices; the oracle SQL uses the same literals).
# ---------------------------------------------------------------------------
WS_CLASS = "[ \\t\\n\\r]"
WORD_RE = "[^ \\t\\n\\r]+"                       # a whitespace-delimited word
PRETOKEN_RE = " ?[^ \\t\\n\\r]+|[ \\t\\n\\r]+"      # BPE pre-token: word with optional leading space, or a whitespace run
LETTER_RE = "\\p{L}"
SYMBOL_RE = "#|\\.\\.\\.|…"                  # '#', '...', '…' (symbol-to-word ratio)
CONTROL_RE = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]"  # C0 controls except \t \n \r (\r is handled by normalize)

EMAIL_RE = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
CARD_RE = "[0-9]{16}"
PHONE_RE = "\\+[0-9]{1,3} \\([0-9]{3}\\) [0-9]{3}-[0-9]{4}"
IPV4_RE = "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}"
SECRET_RE = "(token|secret|api_key|password) ?= ?\"[0-9A-Fa-f]{40}\""
LICENSE_RE = "(?i)(licensed under|released under the|all rights reserved|copyright|©)"

PII_KINDS = ("email", "card", "phone", "ip")     # application order
PII_PATTERNS = {"email": EMAIL_RE, "card": CARD_RE, "phone": PHONE_RE, "ip": IPV4_RE}
PII_TOKENS = {"email": "<EMAIL>", "card": "<CARD>", "phone": "<PHONE>", "ip": "<IP>"}
SECRET_TOKEN = "<SECRET>"

PAD_ID, UNK_ID, EOS_ID = 0, 1, 2
SPECIAL_TOKENS = (("<pad>", PAD_ID), ("<unk>", UNK_ID), ("<eos>", EOS_ID))
IGNORE_ID = -100


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text) -> Column:
    """Whitespace-delimited words, in order."""
    return F.regexp_extract_all(col_(text), F.lit(WORD_RE), 0)


def word_count(text) -> Column:
    return F.regexp_count(col_(text), F.lit(WORD_RE)).cast("bigint")


def collapse_ws(text) -> Column:
    """trim + every whitespace run to one space (the exact-dedup normal form)."""
    t = F.regexp_replace(col_(text), WS_CLASS + "+", " ")
    return F.regexp_replace(t, "\\A | \\z", "")


def dedup_key(text) -> Column:
    """md5 of the lower-cased, whitespace-collapsed text."""
    return F.md5(F.lower(collapse_ws(text)))


def hash_bucket(id_col, seed: int) -> Column:
    """bucket(id, seed) = int(md5(f"{seed}:{id}")[:8], 16) - stable under any partitioning."""
    key = F.concat(F.lit(f"{seed}:"), col_(id_col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def round6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def safe_ratio(num, den) -> Column:
    den = col_(den)
    return F.when(den > 0, round6(col_(num).cast("double") / den.cast("double"))).otherwise(F.lit(0.0))


def ids_text(c) -> Column:
    """An id array as one space-joined string (used for oracle comparison)."""
    return F.array_join(F.transform(col_(c), lambda x: x.cast("string")), " ")


def ngram_strings(words_col, n: int) -> Column:
    """All word n-grams of a words array, each joined by one space, in order.

    Built from n shifted slices zipped together, so the lambda touches only
    its own element: the words array is computed once per row, never once per
    n-gram (a lambda that slices an outer expression may have that expression
    inlined and re-evaluated for every element).
    """
    w = col_(words_col)
    k = F.size(w) - n + 1
    zipped = F.arrays_zip(*[F.slice(w, j + 1, F.greatest(k, F.lit(0))).alias(f"g{j}") for j in range(n)])
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{j}"] for j in range(n)]))
    return F.when(k > 0, grams).otherwise(F.array().cast("array<string>"))


def ngram_hashes(words_col, n: int) -> Column:
    """xxhash64 of every word n-gram string (see ``ngram_strings``)."""
    return F.transform(ngram_strings(words_col, n), lambda g: F.xxhash64(g))
