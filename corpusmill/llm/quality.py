"""Rule-based quality with verdicts on hosts.

Every document is measured against fixed rules.  The failures of a host's
documents are added up, its failure rate is shrunk towards the corpus with an
empirical beta prior, and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import fresh, null_safe, pieces, saved
from corpusmill.session import prepare

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50          # words in repeated 3-word windows
MAX_SYMBOL_PERCENT = 10          # symbols per word
MAX_DUP_LINE_PERCENT = 30        # repeated lines of all lines with a word
MAX_HOST_RATE = 0.5
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = lambda: zip(words, islice(words, 1, None), islice(words, 2, None))
    if len(set(windows())) == n:
        return 0
    ids: dict = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for w in windows()), np.int64, n)
    twice = np.bincount(number)[number] > 1
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k:k + n] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The columns of ``NAMES`` for one text; null is empty."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()                  # bytes.split() cuts at [\x20\x09-\x0D]+ exactly
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, counts of ``NAMES``, base_failed, failed) per row; ``failed``: any rule, soft ones too."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    schema = src.select("doc_id", "host", *[F.lit(0).cast("bigint").alias(n) for n in NAMES],
                        F.lit(True).alias("base_failed"), F.lit(True).alias("failed")).schema

    def run(batches):
        for b in pieces(batches, "text"):
            rows = [measure(t) for t in b.column(2).to_pylist()]
            m = np.array(rows, np.int64).reshape(-1, len(NAMES))
            words, _, symbols, dup, repeat, lines = m.T
            base = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
            soft = (100 * symbols > MAX_SYMBOL_PERCENT * words) | (100 * dup > MAX_DUP_LINE_PERCENT * lines)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(c) for c in m.T], pa.array(base), pa.array(base | soft)],
                names=["doc_id", "host", *NAMES, "base_failed", "failed"])
    return src.mapInArrow(run, schema)


def host_verdicts(stats: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, failures, rate, rejected): failure rates shrunk with an empirical beta prior.

    The prior's mean is the corpus rate; its strength comes from the spread of
    the host rates beyond what chance gives (method of moments, hosts weighted
    by documents).  No such spread, or a single host: the prior is as strong as
    the corpus, and every host is judged at the corpus rate.  A null host is a
    host like the others.
    """
    hosts = stats.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("bigint")).alias("failures"))
    hosts = saved(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("N"), F.sum("failures").alias("K"), F.sum(F.col("n") * F.col("n")).alias("NN"),
                      F.sum(F.col("failures") * F.col("failures") / F.col("n")).alias("S"), F.count(F.lit(1)).alias("H")).first()
    n_all = float(total["N"] or 0)
    mean = total["K"] / n_all if n_all else 0.0
    # Within-host chance and between-host spread of the rates, solved for the intra-host correlation rho.
    n0 = (n_all - total["NN"] / n_all) if n_all else 0.0
    between = (total["S"] - n_all * mean * mean) if n_all else 0.0
    chance = mean * (1 - mean)
    free = total["H"] - 1
    rho = (between - free * chance) / (chance * (n0 - free)) if chance > 0 and n0 > free else 0.0
    strength = min(n_all, 1 / rho - 1) if rho > 0 else n_all
    strength = max(strength, 0.0)
    rate = (F.col("failures") + F.lit(strength * mean)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", "n", "failures", rate.alias("rate"), (rate > F.lit(max_rate)).alias("rejected"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``host_rate`` and ``kept``.

    kept is false if the document fails a base rule (under 50 words, or over
    half of them in repeated 3-word windows), or if it fails a soft rule
    (symbols, repeated lines) and its host is rejected as well: a bad
    host lowers the benefit of the doubt, it does not drop a clean document.
    Null text counts as empty (0 words: failed), a null host is one host,
    repeated rows are measured one by one, an empty table gives an empty
    result, and columns other than the three named are not read.
    """
    stats = saved(rule_stats(docs, id_col, text_col, host_col), "rule-stats")
    hosts = saved(null_safe(host_verdicts(stats, max_host_rate), "host", "h")
                  .select("h_k", "h_n", F.col("rate").alias("host_rate"), "rejected"), "host-verdicts")
    out = null_safe(stats, "host", "h").join(hosts, ["h_k", "h_n"], "left")
    return out.select("doc_id", *NAMES[:5], "base_failed",
                      (~F.col("base_failed") & ~(F.col("failed") & F.col("rejected"))).alias("kept"), "host_rate")


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source", id_col: str = "doc_id",
                   max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps, all columns unchanged, text never shuffled.

    The host rates need one pass over the texts, the filter a second; the
    rejected hosts are joined on the host, a table of one row per host.
    """
    stats = rule_stats(docs, id_col, text_col, host_col).select("host", "failed")
    bad = saved(null_safe(host_verdicts(stats, max_host_rate).where("rejected"), "host", "h").select("h_k", "h_n"), "bad-hosts")
    schema, at = docs.schema, docs.columns.index(text_col)

    def clean(batches, soft: bool):
        for b in pieces(batches, text_col):
            keep = []
            for t in b.column(at).to_pylist():
                words, _, symbols, dup, repeat, lines = measure(t)
                ok = not base_failed(words, repeat)
                keep.append(ok and not (soft and (100 * symbols > MAX_SYMBOL_PERCENT * words
                                                  or 100 * dup > MAX_DUP_LINE_PERCENT * lines)))
            yield b.filter(pa.array(keep, pa.bool_()))
    if bad.limit(1).count() == 0:
        return docs.mapInArrow(lambda x: clean(x, False), schema)
    names = list(docs.columns)
    k, n = fresh(docs, "cm_host", "cm_null")
    keyed = docs.withColumns({k: F.coalesce(F.col(host_col).cast("string"), F.lit("")), n: F.col(host_col).isNull()})
    on = (keyed[k] == bad["h_k"]) & (keyed[n] == bad["h_n"])
    fine = keyed.join(bad, on, "left_anti").select(*names)
    poor = keyed.join(bad, on, "left_semi").select(*names)
    return fine.mapInArrow(lambda x: clean(x, False), schema).unionAll(poor.mapInArrow(lambda x: clean(x, True), schema))
