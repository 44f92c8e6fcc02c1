"""DuckDB SQL that computes the same result as each registered query.

Built from the same fixed patterns as the Spark expressions so the two
engines read identical regexes.  Tables are the driver's views
(documents, benchmark, labels, conversations, ...).
"""

from __future__ import annotations

from corpusmill.functions import text as tx
from corpusmill.operators import windows as W

NL = "chr(10)"


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_count(expr: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({expr}, {q(pattern)})) AS BIGINT)"


def word_count(expr: str) -> str:
    return rx_count(expr, tx.WORD_RE)


def collapse_ws(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, {q(tx.WS_CLASS + '+')}, ' ', 'g'), {q('\\A | \\z')}, '', 'g')"


def dedup_key(expr: str) -> str:
    return f"md5(lower({collapse_ws(expr)}))"


def bucket(id_expr: str, seed: int) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({id_expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def normalize(expr: str) -> str:
    t = f"regexp_replace({expr}, {q(chr(92) + 'r' + chr(92) + 'n?')}, {NL}, 'g')"
    t = f"regexp_replace({t}, {q('[ ' + chr(92) + 't]+')}, ' ', 'g')"
    t = f"regexp_replace({t}, {q(' ?' + chr(92) + 'n ?')}, {NL}, 'g')"
    t = f"regexp_replace({t}, {q(chr(92) + 'n{3,}')}, {NL} || {NL}, 'g')"
    return f"regexp_replace({t}, {q(chr(92) + 'A[ ' + chr(92) + 'n]+|[ ' + chr(92) + 'n]+' + chr(92) + 'z')}, '', 'g')"


def strip_control(expr: str) -> str:
    return f"regexp_replace({expr}, {q(tx.CONTROL_RE)}, '', 'g')"


def ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN round(CAST({num} AS DOUBLE) / ({den}), 6) ELSE 0.0 END"


def window_count(n: str, L: int = W.MAX_SEQ_LENGTH, O: int = W.OVERLAP) -> str:
    S = L - O
    return (f"CAST(CASE WHEN {n} <= 0 THEN 0 WHEN {n} <= {L} THEN 1 "
            f"ELSE 1 + ({n} - {L} + {S - 1}) // {S} END AS BIGINT)")


def ids_text(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


def quality_stats_sql(src: str = "documents") -> str:
    ws = q(tx.WS_CLASS)
    lines = f"list_filter(string_split(text, {NL}), lambda l: length(regexp_replace(l, {ws}, '', 'g')) > 0)"
    return f"""
SELECT doc_id, n_words,
       {ratio('nonspace', 'n_words')} AS mean_word_len,
       {ratio('letters', 'n_chars')} AS alpha_ratio,
       {ratio('symbols', 'n_words')} AS symbol_ratio,
       {ratio('n_lines - n_distinct', 'n_lines')} AS dup_line_ratio
FROM (
  SELECT doc_id, {word_count('text')} AS n_words,
         CAST(length(text) AS BIGINT) AS n_chars,
         CAST(length(regexp_replace(text, {ws}, '', 'g')) AS BIGINT) AS nonspace,
         CAST(length(regexp_replace(text, {q('[^' + chr(92) + 'p{L}]')}, '', 'g')) AS BIGINT) AS letters,
         {rx_count('text', tx.SYMBOL_RE)} AS symbols,
         CAST(len({lines}) AS BIGINT) AS n_lines,
         CAST(len(list_distinct({lines})) AS BIGINT) AS n_distinct
  FROM {src})"""


def quality_filter_sql(src: str = "documents", min_alpha=0.6, max_symbol=0.1, max_dup=0.3, wl=(2, 12)) -> str:
    return f"""
SELECT doc_id, reason = 'ok' AS keep, reason FROM (
  SELECT doc_id, CASE WHEN mean_word_len < {wl[0]} OR mean_word_len > {wl[1]} THEN 'word_len'
                      WHEN alpha_ratio < {min_alpha} THEN 'alpha'
                      WHEN symbol_ratio > {max_symbol} THEN 'symbol'
                      WHEN dup_line_ratio > {max_dup} THEN 'dup_lines'
                      ELSE 'ok' END AS reason
  FROM ({quality_stats_sql(src)}))"""


def word_vocab_sql(vocab_size: int = 25000, src: str = "documents") -> str:
    k = vocab_size - len(tx.SPECIAL_TOKENS)
    return f"""
SELECT CAST(row_number() OVER (ORDER BY n DESC, word ASC) + 2 AS INTEGER) AS token_id, word, n FROM (
  SELECT word, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT unnest(regexp_extract_all(text, {q(tx.WORD_RE)})) AS word FROM {src})
  GROUP BY word ORDER BY n DESC, word ASC LIMIT {k})"""


def word_encode_sql(src: str = "documents", vocab_size: int = 25000, vocab_src: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> str:
    """(id, ids LIST<INTEGER>, n_tokens) - the E2 encoding of ``src``."""
    vocab_src = vocab_src or src
    return f"""
SELECT d.{id_col} AS {id_col}, coalesce(e.ids, CAST([] AS INTEGER[])) AS ids,
       CAST(len(coalesce(e.ids, CAST([] AS INTEGER[]))) AS BIGINT) AS n_tokens
FROM {src} d LEFT JOIN (
  SELECT t.{id_col}, list(CAST(coalesce(v.token_id, {tx.UNK_ID}) AS INTEGER) ORDER BY t.pos) AS ids
  FROM (SELECT {id_col}, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT {id_col}, regexp_extract_all({text_col}, {q(tx.WORD_RE)}) AS w FROM {src})) t
  LEFT JOIN ({word_vocab_sql(vocab_size, vocab_src)}) v ON t.word = v.word
  GROUP BY t.{id_col}) e ON d.{id_col} = e.{id_col}"""


def windows_sql(encoded: str, L: int = W.MAX_SEQ_LENGTH, O: int = W.OVERLAP, id_col: str = "doc_id") -> str:
    """(id, window_ix, wids LIST, n_tokens) from an encoded relation (id, ids, n_tokens)."""
    S = L - O
    return f"""
SELECT {id_col}, window_ix, wids, CAST(len(wids) AS BIGINT) AS n_tokens FROM (
  SELECT {id_col}, CAST(ix AS INTEGER) AS window_ix, list_slice(ids, ix * {S} + 1, ix * {S} + {L}) AS wids
  FROM (SELECT {id_col}, ids, unnest(range(0, {window_count('n_tokens', L, O)})) AS ix FROM ({encoded})))"""


def indexed_windows_sql(encoded: str, L: int = W.MAX_SEQ_LENGTH, O: int = W.OVERLAP, id_col: str = "doc_id") -> str:
    return f"""
SELECT w.*, CAST(s.start + w.window_ix AS BIGINT) AS sample_id
FROM ({windows_sql(encoded, L, O, id_col)}) w JOIN (
  SELECT {id_col}, CAST(coalesce(sum(nw) OVER (ORDER BY {id_col} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM (SELECT {id_col}, {window_count('n_tokens', L, O)} AS nw FROM ({encoded}))) s USING ({id_col})"""


def ngrams_sql(src: str, id_col: str, n: int, text_col: str = "text", distinct: bool = True) -> str:
    """(id, g) word n-grams of lower(text) (1-based list_slice, inclusive end)."""
    d = "DISTINCT " if distinct else ""
    return f"""
SELECT {d}{id_col}, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS g
FROM (SELECT {id_col}, w, unnest(range(1, len(w) - {n - 2})) AS i
      FROM (SELECT {id_col}, regexp_extract_all(lower({text_col}), {q(tx.WORD_RE)}) AS w FROM {src}))"""


def near_pairs_sql(src: str = "documents", n: int = 5, threshold: float = 0.8) -> str:
    """Exact Jaccard >= threshold over distinct word n-shingles (brute force self-join)."""
    return f"""
SELECT a, b, j AS jaccard FROM (
  SELECT i.a, i.b, round(CAST(i.k AS DOUBLE) / (sa.n + sb.n - i.k), 6) AS j
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
        FROM ({ngrams_sql(src, 'doc_id', n)}) x JOIN ({ngrams_sql(src, 'doc_id', n)}) y
          ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) i
  JOIN (SELECT doc_id, count(*) AS n FROM ({ngrams_sql(src, 'doc_id', n)}) GROUP BY doc_id) sa ON sa.doc_id = i.a
  JOIN (SELECT doc_id, count(*) AS n FROM ({ngrams_sql(src, 'doc_id', n)}) GROUP BY doc_id) sb ON sb.doc_id = i.b)
WHERE j >= {threshold}"""


def components_sql(src: str = "documents", near: bool = True) -> str:
    """(doc_id, component) over exact-key copies and (optionally) near pairs, via a recursive walk."""
    exact = f"""SELECT m.k AS a, d.doc_id AS b FROM
  (SELECT doc_id, {dedup_key('text')} AS key FROM {src}) d
  JOIN (SELECT {dedup_key('text')} AS key, min(doc_id) AS k FROM {src} GROUP BY 1) m USING (key)
  WHERE d.doc_id <> m.k"""
    pairs = exact + (f" UNION SELECT a, b FROM ({near_pairs_sql(src)})" if near else "")
    return f"""
WITH RECURSIVE p AS ({pairs}),
e AS (SELECT a AS s, b AS d FROM p UNION SELECT b AS s, a AS d FROM p),
walk(id, c) AS (SELECT doc_id, doc_id FROM {src} UNION SELECT e.d, walk.c FROM walk JOIN e ON walk.id = e.s)
SELECT id AS doc_id, min(c) AS component FROM walk GROUP BY id"""


def near_only_components_sql(src: str = "documents") -> str:
    return f"""
WITH RECURSIVE p AS (SELECT a, b FROM ({near_pairs_sql(src)})),
e AS (SELECT a AS s, b AS d FROM p UNION SELECT b AS s, a AS d FROM p),
walk(id, c) AS (SELECT doc_id, doc_id FROM {src} UNION SELECT e.d, walk.c FROM walk JOIN e ON walk.id = e.s)
SELECT id AS doc_id, min(c) AS component FROM walk GROUP BY id"""
