"""Document cleaning rules (normalize, filters, quality, redaction, funnel).

All rules are column expressions: they run inside the scan stage with no
shuffle, and Catalyst pushes the projection down to the parquet reader.
Only ``line_dedup`` (a corpus-wide line count) and ``clean_funnel`` /
``rule_calibration`` (aggregations) shuffle, and they shuffle hashes and
ids, never document text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.joins import (DEFAULT_MAX_BROADCAST_ROWS, WIDE_MAX_BROADCAST_ROWS, checked_join,
                                        materialize, sized)


# --- B1 / B2 ---------------------------------------------------------------

def normalize_expr(text) -> "F.Column":
    t = F.regexp_replace(tx.col_(text), "\\r\\n?", "\n")        # CRLF / CR -> LF
    t = F.regexp_replace(t, "[ \\t]+", " ")                     # space/tab runs -> one space
    t = F.regexp_replace(t, " ?\\n ?", "\n")                    # no space next to a newline
    t = F.regexp_replace(t, "\\n{3,}", "\n\n")                  # at most one blank line
    return F.regexp_replace(t, "\\A[ \\n]+|[ \\n]+\\z", "")     # trim


def normalize_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """B1: trim; CRLF->LF; space/tab runs -> one space; >=3 newlines -> 2."""
    return df.withColumn(text_col, normalize_expr(text_col))


def strip_control_expr(text) -> "F.Column":
    return F.regexp_replace(F.make_valid_utf8(tx.col_(text)), tx.CONTROL_RE, "")


def strip_control(df: DataFrame, text_col: str = "text") -> DataFrame:
    """B2: repair invalid UTF-8; drop C0 control characters (keeping tab/newline/CR)."""
    return df.withColumn(text_col, strip_control_expr(text_col))


# --- B3 ---------------------------------------------------------------------

def keep_if(df: DataFrame, col: str, cond) -> DataFrame:
    """Rows whose ``col`` satisfies ``cond(value)``, evaluating ``col`` once per row.

    A plain ``where`` is pushed below the projection that computes ``col``
    and then re-evaluates that (regex-heavy) expression once per reference.
    Exploding a 0/1-element ``filter(array(col), cond)`` binds the value
    once - a generator the optimizer keeps in place.
    """
    others = [c for c in df.columns if c != col]
    kept = F.explode(F.filter(F.array(F.col(col)), cond)).alias(col)
    return df.select(*others, kept).select(*df.columns)


def length_filter(df: DataFrame, min_chars: int = 200, max_chars: int = 100_000,
                  min_words: int = 50, text_col: str = "text") -> DataFrame:
    """Keep min_chars <= length <= max_chars and words >= min_words."""
    return keep_if(df, text_col, lambda t: F.length(t).between(min_chars, max_chars) &
                   (tx.word_count(t) >= min_words))


# --- B4 / B5 ----------------------------------------------------------------

def _stat_columns(text_col: str):
    t = F.col(text_col)
    lines = F.filter(F.split(t, "\n"), lambda l: F.length(F.regexp_replace(l, tx.WS_CLASS, "")) > 0)
    n_words = tx.word_count(t)
    return {
        "n_words": n_words,
        "mean_word_len": tx.safe_ratio(F.length(F.regexp_replace(t, tx.WS_CLASS, "")), n_words),
        "alpha_ratio": tx.safe_ratio(F.length(F.regexp_replace(t, "[^\\p{L}]", "")), F.length(t)),
        "symbol_ratio": tx.safe_ratio(F.regexp_count(t, F.lit(tx.SYMBOL_RE)), n_words),
        "dup_line_ratio": tx.safe_ratio(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
    }


def quality_stats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per-document statistics; ratios rounded to 6 places.

    mean_word_len = non-whitespace chars / words; alpha_ratio = letters / chars;
    symbol_ratio = ('#', '...', '…') occurrences / words;
    dup_line_ratio = 1 - distinct / non-blank lines.
    """
    return df.select(F.col(id_col), *[c.alias(k) for k, c in _stat_columns(text_col).items()])


def annotate_quality(df: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """B4 + B5 as extra columns on the documents themselves (no join back)."""
    out = df
    for k, c in _stat_columns(text_col).items():
        out = out.withColumn(k, c)
    return out.withColumn("reason", _reason(**thresholds)).withColumn("keep", F.col("reason") == "ok")


QUALITY_REASONS = ("word_len", "alpha", "symbol", "dup_lines")


def _reason(min_alpha: float = 0.6, max_symbol: float = 0.1, max_dup_lines: float = 0.3,
            word_len: tuple = (2, 12)):
    lo, hi = word_len
    return (F.when((F.col("mean_word_len") < lo) | (F.col("mean_word_len") > hi), "word_len")
             .when(F.col("alpha_ratio") < min_alpha, "alpha")
             .when(F.col("symbol_ratio") > max_symbol, "symbol")
             .when(F.col("dup_line_ratio") > max_dup_lines, "dup_lines")
             .otherwise("ok"))


def quality_filter(stats: DataFrame, min_alpha: float = 0.6, max_symbol: float = 0.1,
                   max_dup_lines: float = 0.3, word_len: tuple = (2, 12),
                   id_col: str = "doc_id") -> DataFrame:
    """(doc_id, keep, reason) - reason is the first failing rule, in fixed order."""
    reason = _reason(min_alpha, max_symbol, max_dup_lines, word_len)
    return stats.select(F.col(id_col), (reason == "ok").alias("keep"), reason.alias("reason"))


# --- B6 ---------------------------------------------------------------------

def lang_filter(df: DataFrame, langs, lang_col: str = "lang") -> DataFrame:
    """Keep documents whose supplied language is in ``langs``."""
    return df.where(F.col(lang_col).isin(list(langs)))


# --- B10 --------------------------------------------------------------------

# Largest hash set written into an expression (optimised to a hash-set lookup).
MAX_INLINE_KEYS = 20_000


def line_dedup(df: DataFrame, min_words: int = 3, min_docs: int = 10, text_col: str = "text",
               id_col: str = "doc_id", max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               max_inline_keys: int = MAX_INLINE_KEYS) -> DataFrame:
    """Drop lines of >= min_words words that occur in >= min_docs distinct documents.

    The corpus-wide count shuffles (line md5, doc_id) pairs only.  It first
    de-duplicates (md5, doc_id) - hashed on both columns, so a boilerplate
    line present in a third of all documents is spread over every task -
    and then counts per md5 with map-side partial aggregation.

    Rewriting the text needs the set of frequent line hashes.  When it is
    small (the usual boilerplate case, at most ``max_inline_keys``) the set
    is written into the projection as an IN-list, which Spark evaluates as a
    hash-set lookup: documents are rewritten in place, with no join and no
    shuffle of text.  A larger set is matched per line with a join (broadcast
    only under a measured size) and the drop positions are joined back by
    doc_id.
    """
    lines = (df.select(F.col(id_col), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
               .where(tx.word_count("line") >= min_words)
               .select(id_col, "pos", F.md5("line").alias("h")))
    frequent = (lines.select("h", id_col).distinct()
                .groupBy("h").count().where(F.col("count") >= min_docs).select("h"))
    frequent, n_frequent = sized(frequent)
    if n_frequent == 0:
        return df
    if n_frequent <= max_inline_keys:
        hashes = [r["h"] for r in frequent.collect()]          # bounded by max_inline_keys
        kept = F.filter(F.split(F.col(text_col), "\n"),
                        lambda l: ~((tx.word_count(l) >= min_words) & F.md5(l).isin(hashes)))
        return df.withColumn(text_col, F.array_join(kept, "\n"))
    bad = F.broadcast(frequent) if n_frequent <= max_broadcast_rows else frequent
    drops = (lines.join(bad, "h", "left_semi")
                  .groupBy(id_col).agg(F.collect_set("pos").alias("drop_pos_")))
    drops, n_drop_docs = sized(drops)
    right = F.broadcast(drops) if n_drop_docs <= min(max_broadcast_rows, WIDE_MAX_BROADCAST_ROWS) else drops
    out = df.join(right, id_col, "left")
    kept = F.filter(F.split(F.col(text_col), "\n"),
                    lambda l, i: F.coalesce(~F.array_contains(F.col("drop_pos_"), i), F.lit(True)))
    return out.withColumn(text_col, F.array_join(kept, "\n")).drop("drop_pos_")


# --- B11 / B12 / B13 --------------------------------------------------------

def license_strip(df: DataFrame, pattern: str = tx.LICENSE_RE, text_col: str = "text") -> DataFrame:
    """Drop lines that match licence / copyright patterns."""
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda l: ~l.rlike(pattern))
    return df.withColumn(text_col, F.array_join(kept, "\n"))


def pii_redact(df: DataFrame, kinds=tx.PII_KINDS, text_col: str = "text") -> DataFrame:
    """E-mail / card / phone / IPv4 -> placeholder tokens, with a count per kind.

    Kinds are applied in the fixed order email, card, phone, ip; each count
    is taken on the text left by the previous replacements.
    """
    out = df
    for kind in tx.PII_KINDS:
        if kind not in kinds:
            continue
        pat = tx.PII_PATTERNS[kind]
        out = (out.withColumn(f"n_{kind}", F.regexp_count(F.col(text_col), F.lit(pat)).cast("bigint"))
                  .withColumn(text_col, F.regexp_replace(F.col(text_col), pat, tx.PII_TOKENS[kind])))
    return out


def secret_redact(df: DataFrame, pattern: str = tx.SECRET_RE, text_col: str = "text") -> DataFrame:
    """Credential assignments (``token = "<40 hex>"``) -> <SECRET>, with a count."""
    return (df.withColumn("n_secret", F.regexp_count(F.col(text_col), F.lit(pattern)).cast("bigint"))
              .withColumn(text_col, F.regexp_replace(F.col(text_col), pattern, tx.SECRET_TOKEN)))


# --- B15 / B16 --------------------------------------------------------------

def clean_funnel(stages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows and bytes entering/leaving each stage, by lang, source and in total.

    ``stages`` is an ordered dict or list of (name, DataFrame); each frame holds the
    documents surviving that stage (a subset of the previous one).  One
    union + one rollup aggregation; ``dropped`` comes from a window over
    the (tiny) aggregated result.
    """
    parts = []
    items = stages.items() if isinstance(stages, dict) else stages
    for ix, (name, sdf) in enumerate(items):
        parts.append(sdf.select(F.lit(ix).alias("stage_ix"), F.lit(name).alias("stage"),
                                "lang", "source", F.octet_length(text_col).cast("bigint").alias("b")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return _funnel_rollup(u)


STANDARD_STAGES = ("raw", "length", "quality", "exact_dedup")


def standard_funnel(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    length_kw: dict | None = None, quality_kw: dict | None = None) -> DataFrame:
    """B15 for the standard chain raw -> length (B3) -> quality (B5) -> exact dedup (B7), in one pass.

    Every text-derived value is computed once into a narrow table
    (id, lang, source, bytes, passes, dedup key) - the text is read once and
    never shuffled; the dedup step shuffles (key, id) only.  Each document
    then contributes one row per stage it reached to a single rollup.
    """
    lk = {"min_chars": 200, "max_chars": 100_000, "min_words": 50, **(length_kw or {})}
    t = F.col(text_col)
    stats = _stat_columns(text_col)
    reason = _reason(**(quality_kw or {}))
    narrow = (df.select(F.col(id_col), "lang", "source", F.octet_length(t).cast("bigint").alias("b"),
                        (F.length(t).between(lk["min_chars"], lk["max_chars"]) &
                         (tx.word_count(t) >= lk["min_words"])).alias("p_len"),
                        *[c.alias(k) for k, c in stats.items()], tx.dedup_key(t).alias("k"))
                .withColumn("p_q", F.col("p_len") & (reason == "ok"))
                .select(id_col, "lang", "source", "b", "p_len", "p_q", "k"))
    narrow = materialize(narrow)
    # Only keys with copies matter for the dedup stage; that (measured) table joins back.
    groups = (narrow.where("p_q").groupBy("k")
                    .agg(F.min(id_col).alias("_first_"), F.count(F.lit(1)).alias("_n_"))
                    .where(F.col("_n_") > 1).select("k", "_first_"))
    flagged = checked_join(narrow, groups, "k", "left")
    survives = F.col("p_q") & F.coalesce(F.col(id_col) == F.col("_first_"), F.lit(True))
    reached = F.col("p_len").cast("int") + F.col("p_q").cast("int") + survives.cast("int")
    names = F.array(*[F.lit(n) for n in STANDARD_STAGES])
    rows = flagged.select("lang", "source", "b", F.explode(F.sequence(F.lit(0), reached)).alias("stage_ix")) \
                  .withColumn("stage", F.element_at(names, F.col("stage_ix") + 1))
    return _funnel_rollup(rows)


def _funnel_rollup(u: DataFrame) -> DataFrame:
    agg = (u.rollup("stage_ix", "stage", "lang", "source")
             .agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("b").cast("bigint").alias("bytes"),
                  F.grouping_id().alias("gid"))
             .where(F.col("stage").isNotNull() & F.col("gid").isin(0, 1, 3)))
    w = Window.partitionBy("lang", "source", "gid").orderBy("stage_ix")
    prev_rows = F.lag("rows").over(w)
    return agg.select("stage", "lang", "source", "rows", "bytes",
                      F.coalesce(prev_rows - F.col("rows"), F.lit(0)).cast("bigint").alias("dropped"))


def rule_calibration(decisions: DataFrame, labels: DataFrame, docs: DataFrame,
                     id_col: str = "doc_id") -> DataFrame:
    """Precision / recall of ``keep`` against ``labels.quality``, per language."""
    j = (decisions.join(labels.select(id_col, "quality"), id_col)
                  .join(docs.select(id_col, "lang"), id_col))
    k, q = F.col("keep"), F.col("quality") == 1

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    agg = j.groupBy("lang").agg(cnt(k & q).alias("tp"), cnt(k & ~q).alias("fp"),
                                cnt(~k & q).alias("fn"), cnt(~k & ~q).alias("tn"))
    return agg.select("lang", "tp", "fp", "fn", "tn",
                      tx.safe_ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
                      tx.safe_ratio("tp", F.col("tp") + F.col("fn")).alias("recall"))


# --- H3: user rules -------------------------------------------------------------

def apply_rules(df: DataFrame, rules, text_col: str = "text") -> DataFrame:
    """H3: user cleaning rules -> (keep, reason) columns, reason = first failing rule.

    ``rules`` is an ordered list of (name, rule); a rule is a Column that is
    true when the row passes, or a function text_column -> Column (a built-in
    expression, or a ``pandas_udf`` returning booleans for the slow path).
    """
    reason = None
    for name, rule in rules:
        ok = rule(F.col(text_col)) if callable(rule) else rule
        fail = F.coalesce(~ok, F.lit(True))
        reason = F.when(fail, F.lit(name)) if reason is None else reason.when(fail, F.lit(name))
    reason = F.lit("ok") if reason is None else reason.otherwise(F.lit("ok"))
    return df.withColumn("reason", reason).withColumn("keep", F.col("reason") == "ok")
