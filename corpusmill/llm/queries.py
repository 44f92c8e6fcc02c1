"""Registered queries of this subpackage: thin forms of the operators, one per contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.llm.common import WORD_RE, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_masked_pseudo_likelihood")
def op1(spark, sf_dir):
    from corpusmill.llm.lm import pseudo_likelihood
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT doc_id, x, length(x) // 2 AS n FROM d),
w AS (SELECT doc_id, p, substr(x, CAST(2 * p + 1 AS BIGINT), 100) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS p FROM n WHERE n >= 50)),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS first FROM w),
r AS (SELECT doc_id, p FROM f WHERE first < doc_id),
o AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM r),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM o),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, k),
e AS (SELECT doc_id, b AS a0, lead(a) OVER (PARTITION BY doc_id ORDER BY a, b) AS b FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, 0, 0 FROM n)),
kept AS (SELECT e.doc_id, string_agg(substr(x, CAST(2 * a0 + 1 AS BIGINT), CAST(2 * (coalesce(b, n) - a0) AS BIGINT)), '' ORDER BY a0) AS x FROM e JOIN n ON e.doc_id = n.doc_id GROUP BY e.doc_id),
g AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS c FROM spans GROUP BY doc_id)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
  lower(sha256(unhex(kept.x))) AS kept_sha256
FROM n LEFT JOIN g ON n.doc_id = g.doc_id JOIN kept ON n.doc_id = kept.doc_id"""


@register("op2_bwt_merge_dedup", OP2_SQL)
def op2(spark, sf_dir):
    from corpusmill.llm.suffix import removals
    return removals(table(spark, sf_dir, "documents"))


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP3_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
v AS (SELECT page_id, n, x, max(page_id) OVER (PARTITION BY x, n) AS keeper FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_B32}', CAST(1 + (
    (CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM v"""


@register("op3_warc_segment_reassembly", OP3_SQL)
def op3(spark, sf_dir):
    from corpusmill.llm.warc import archive_round_trip
    return archive_round_trip(table(spark, sf_dir, "pages"))


@register("op4_hyperdimensional_language_id")
def op4(spark, sf_dir):
    from corpusmill.llm.langid import identify_languages
    return identify_languages(table(spark, sf_dir, "documents"))


@register("op5_segment_toxicity")
def op5(spark, sf_dir):
    from corpusmill.llm.toxicity import toxicity
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("bigint").alias("n_passages"))


@register("op6_wand_decontamination")
def op6(spark, sf_dir):
    from corpusmill.llm.decontam import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_information_theoretic_pii")
def op7(spark, sf_dir):
    from corpusmill.llm.pii import private_spans, span_rows
    return span_rows(private_spans(table(spark, sf_dir, "documents")))


@register("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    from corpusmill.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)


OP9_SQL = rf"""
WITH w AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '{WORD_RE}') AS ws FROM documents),
pos AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, ws FROM w WHERE len(ws) >= 3),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM pos WHERE i + 2 <= len(ws)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS r FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS d FROM ln
        WHERE regexp_matches(line, '{WORD_RE}') GROUP BY doc_id),
m AS (SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(coalesce(d, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id LEFT JOIN dup ON w.doc_id = dup.doc_id),
s AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
        (100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines) AS soft FROM m),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN base_failed OR soft THEN 1 ELSE 0 END) AS DOUBLE) AS f FROM s GROUP BY source),
t AS (SELECT sum(n) AS nn, sum(f) / sum(n) AS mean, sum(n) - sum(n * n) / sum(n) AS n0, sum(f * f / n) AS sp, count(*) - 1 AS free FROM h),
p AS (SELECT *, CASE WHEN mean * (1 - mean) > 0 AND n0 > free
        THEN ((sp - nn * mean * mean) - free * mean * (1 - mean)) / (mean * (1 - mean) * (n0 - free)) ELSE 0 END AS rho FROM t),
q AS (SELECT mean, CASE WHEN rho > 0 THEN greatest(least(nn, 1 / rho - 1), 0) ELSE nn END AS a FROM p),
v AS (SELECT source, (f + a * mean) / (n + a) AS rate FROM h, q)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND NOT (soft AND rate > 0.5)) AS kept, CAST(round(rate, 6) AS DOUBLE) AS host_rate
FROM s JOIN v ON s.source IS NOT DISTINCT FROM v.source"""


@register("op9_host_quality_rules", OP9_SQL)
def op9(spark, sf_dir):
    from corpusmill.llm.quality import quality_verdicts
    return quality_verdicts(table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 6))


@register("op10_entropy_balanced_mix")
def op10(spark, sf_dir):
    from corpusmill.llm.mixing import mix, mix_rows
    return mix_rows(mix(table(spark, sf_dir, "documents")))


@register("op11_digest_run_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op11(spark, sf_dir):
    from corpusmill.llm.digestruns import exact_groups
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def _op12_sql(levels: int = 6, upper: int = 3) -> str:
    """Trees of up to 16 ** levels rows a source, 16 ** upper sources; a node that is alone in its tree goes up unchanged."""
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"
    ids, text = [field(c) for c in ("doc_id", "source", "lang", "n_chars")], "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           f"lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: {byte}), 4294967295)")
    out = [f"""WITH d AS (SELECT doc_id, source, sha256({' || '.join([*ids, field('text')])}) AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN sha256({' || '.join([*ids, field(text)])}) END AS altered FROM documents),
x0 AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS gid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  doc_id, leaf, coalesce(altered, leaf) AS folded, '' AS proof FROM d),
n0 AS (SELECT gid, pos, leaf AS h, count(*) OVER (PARTITION BY gid) AS n FROM x0)"""]

    def climb(k):
        out.append(f"""s{k} AS (SELECT gid, pos, h, n,
  coalesce(string_agg(h, '') OVER (PARTITION BY gid, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') OVER (PARTITION BY gid, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM n{k}),
x{k + 1} AS (SELECT x.* REPLACE (x.pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(a || folded || b) ELSE folded END AS folded,
  proof || a || b AS proof) FROM x{k} x JOIN s{k} s ON x.gid = s.gid AND x.pos = s.pos),
n{k + 1} AS (SELECT gid, pos // 16 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
  (any_value(n) + 15) // 16 AS n FROM n{k} GROUP BY gid, pos // 16)""")
    for k in range(levels):
        climb(k)
    m = levels + 1
    out.append(f"""x{m} AS (SELECT x.* REPLACE (0 AS gid, x.gid AS pos), n.h AS subroot FROM x{levels} x JOIN n{levels} n ON x.gid = n.gid),
n{m} AS (SELECT 0 AS gid, gid AS pos, h, count(*) OVER () AS n FROM n{levels})""")
    for k in range(m, m + upper):
        climb(k)
    end = m + upper
    return ",\n".join(out) + f"""
SELECT x.doc_id, x.leaf, x.subroot, n.h AS root, sha256(x.proof) AS proof_sha256, x.folded AS folded_root, x.folded = n.h AS verified FROM x{end} x, n{end} n"""


@register("op12_slot_pivot_manifest", _op12_sql())
def op12(spark, sf_dir):
    from corpusmill.llm.merkle import proofs
    return proofs(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
m AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS BIGINT) AS m),
i AS (SELECT lang, m, ws, unnest(range(1, CAST(len(ws) - m + 2 AS BIGINT))) AS i FROM w, m WHERE len(ws) >= m),
g AS (SELECT lang, m, ws[i:i + m - 1] AS g, count(*) AS f FROM i GROUP BY ALL),
c AS (SELECT lang, m, g, f AS a FROM g WHERE m > 1 AND f >= 100),
sub AS (SELECT lang, g[x:y] AS g, max(a) AS longer FROM (SELECT lang, m, g, a, unnest(range(1, m + 1)) AS x FROM c), (SELECT unnest([2, 3, 4, 5]) AS y)
  WHERE y > x AND y <= m AND y - x + 1 < m GROUP BY ALL),
alive AS (SELECT c.* FROM c LEFT JOIN sub ON c.lang = sub.lang AND c.g = sub.g WHERE sub.longer IS NULL OR 100 * sub.longer < 100 * c.a),
k AS (SELECT *, unnest(range(1, m)) AS k FROM alive),
s AS (SELECT k.lang, k.g, k.a, k.k, x.f AS l, y.f AS r, t.n,
  CAST((CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM k JOIN t ON k.lang = t.lang JOIN g x ON x.lang = k.lang AND x.g = k.g[1:k.k] JOIN g y ON y.lang = k.lang AND y.g = k.g[k.k + 1:]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS b FROM s),
o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM best WHERE b = 1)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o) WHERE rank <= 2000"""


@register("op13_branch_and_bound_collocations", OP13_SQL)
def op13(spark, sf_dir):
    from corpusmill.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))
