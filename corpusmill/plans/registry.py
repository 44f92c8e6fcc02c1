"""Registered queries: one per operator of the inventory, each over the given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same tables) are exposed through ``__spark_entry__``.  Array
results are shown as space-joined id strings so both engines print them
identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import clean, dedup, encode, sample
from corpusmill.operators import windows as W
from corpusmill.plans import oracle_sql as O
from corpusmill.sources.corpus import table, with_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# ---------------------------------------------------------------------------
# A: sources
# ---------------------------------------------------------------------------

@register("select_text", "SELECT doc_id, text FROM documents")
def q_select_text(spark, sf_dir):
    return with_text(docs(spark, sf_dir), "text")


# ---------------------------------------------------------------------------
# B: cleaning
# ---------------------------------------------------------------------------

@register("normalize_text", f"SELECT doc_id, {O.normalize('text')} AS text FROM documents")
def q_normalize_text(spark, sf_dir):
    return clean.normalize_text(docs(spark, sf_dir).select("doc_id", "text"))


@register("strip_control", f"SELECT doc_id, {O.strip_control('text')} AS text FROM documents")
def q_strip_control(spark, sf_dir):
    return clean.strip_control(docs(spark, sf_dir).select("doc_id", "text"))


@register("length_filter", f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, {O.word_count('text')} AS n_words FROM documents
WHERE length(text) BETWEEN 200 AND 100000 AND {O.word_count('text')} >= 50""")
def q_length_filter(spark, sf_dir):
    d = clean.length_filter(docs(spark, sf_dir))
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), tx.word_count("text").alias("n_words"))


@register("quality_stats", O.quality_stats_sql())
def q_quality_stats(spark, sf_dir):
    return clean.quality_stats(docs(spark, sf_dir))


@register("quality_filter", O.quality_filter_sql())
def q_quality_filter(spark, sf_dir):
    return clean.quality_filter(clean.quality_stats(docs(spark, sf_dir)))


@register("lang_filter", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def q_lang_filter(spark, sf_dir):
    return clean.lang_filter(docs(spark, sf_dir), ["en", "de"]).select("doc_id", "lang")


@register("exact_dedup", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {O.dedup_key('text')}")
def q_exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(docs(spark, sf_dir)).select("doc_id")


# ---------------------------------------------------------------------------
# C: sampling / splitting
# ---------------------------------------------------------------------------

@register("hash_sample", f"SELECT doc_id FROM documents WHERE {O.bucket('doc_id', 42)} % 1000 < 100")
def q_hash_sample(spark, sf_dir):
    return sample.hash_sample(docs(spark, sf_dir), 0.10, 42).select("doc_id")


SPLIT_SQL = f"CASE WHEN {O.bucket('doc_id', 43)} % 10000 < 100 THEN 'validation' ELSE 'train' END"


@register("split", f"SELECT doc_id, {SPLIT_SQL} AS split FROM documents")
def q_split(spark, sf_dir):
    return sample.split(docs(spark, sf_dir), 0.01, 43).select("doc_id", "split")


# ---------------------------------------------------------------------------
# D / E: tokens, windows, batches
# ---------------------------------------------------------------------------

@register("pretoken_counts", f"""
SELECT word, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(regexp_extract_all(text, {O.q(tx.PRETOKEN_RE)})) AS word FROM documents) GROUP BY word""")
def q_pretoken_counts(spark, sf_dir):
    from corpusmill.operators import bpe
    return bpe.pretoken_counts(docs(spark, sf_dir))


@register("word_vocab", O.word_vocab_sql())
def q_word_vocab(spark, sf_dir):
    return encode.word_vocab(docs(spark, sf_dir))


def _encoded(spark, sf_dir):
    d = docs(spark, sf_dir)
    return encode.word_encode(d, encode.word_vocab(d))


ENCODED_SQL = O.word_encode_sql()


@register("word_encode", f"SELECT doc_id, n_tokens, {O.ids_text('ids')} AS input_ids FROM ({ENCODED_SQL})")
def q_word_encode(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("doc_id", "n_tokens", tx.ids_text("input_ids").alias("input_ids"))


@register("windows", f"""
SELECT doc_id, window_ix, n_tokens, {O.ids_text('wids')} AS input_ids FROM ({O.windows_sql(ENCODED_SQL)})""")
def q_windows(spark, sf_dir):
    w = W.windows(_encoded(spark, sf_dir))
    return w.select("doc_id", "window_ix", "n_tokens", tx.ids_text("input_ids").alias("input_ids"))


# The minimum end-to-end slice: normalize -> length filter -> exact dedup -> split -> sample count.
_SLICE_SQL = f"""
WITH n AS (SELECT doc_id, {O.normalize('text')} AS text FROM documents),
     f AS (SELECT * FROM n WHERE length(text) BETWEEN 200 AND 100000 AND {O.word_count('text')} >= 50),
     d AS (SELECT * FROM f WHERE doc_id IN (SELECT min(doc_id) FROM f GROUP BY {O.dedup_key('text')})),
     s AS (SELECT doc_id, {SPLIT_SQL} AS split, {O.word_count('text')} AS n_tokens FROM d)
SELECT split, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n_tokens) AS BIGINT) AS tokens,
       CAST(sum({O.window_count('n_tokens')}) AS BIGINT) AS samples
FROM s GROUP BY split"""


def sample_count_slice(d: DataFrame) -> DataFrame:
    d = clean.normalize_text(d.select("doc_id", "text"))
    d = clean.length_filter(d)
    d = dedup.exact_dedup(d)
    d = sample.split(d, 0.01, 43)
    # E2 emits one id per word, so the count needs only the word count: no token arrays.
    enc = d.select("split", tx.word_count("text").alias("n_tokens"))
    return W.sample_count(enc, by=["split"])


@register("sample_count", _SLICE_SQL)
def q_sample_count(spark, sf_dir):
    return sample_count_slice(docs(spark, sf_dir))


# ---------------------------------------------------------------------------
# B: line-level rules, redaction, decontamination, funnel, calibration
# ---------------------------------------------------------------------------

_LINES_SQL = "SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos " \
             "FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"


@register("line_dedup", f"""
WITH l AS ({_LINES_SQL}),
bad AS (SELECT line FROM l WHERE {O.word_count('line')} >= 3 GROUP BY line HAVING count(DISTINCT doc_id) >= 10)
SELECT d.doc_id, coalesce(k.text, '') AS text FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l
  WHERE line NOT IN (SELECT line FROM bad) GROUP BY doc_id) k USING (doc_id)""")
def q_line_dedup(spark, sf_dir):
    return clean.line_dedup(docs(spark, sf_dir).select("doc_id", "text"), min_words=3, min_docs=10)


@register("license_strip", f"""
SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)),
       lambda l: NOT regexp_matches(l, {O.q(tx.LICENSE_RE)})), chr(10)) AS text FROM documents""")
def q_license_strip(spark, sf_dir):
    return clean.license_strip(docs(spark, sf_dir).select("doc_id", "text"))


def _pii_sql() -> str:
    cols, t = [], "text"
    for kind in tx.PII_KINDS:
        pat = tx.PII_PATTERNS[kind]
        cols.append(f"{O.rx_count(t, pat)} AS n_{kind}")
        t = f"regexp_replace({t}, {O.q(pat)}, {O.q(tx.PII_TOKENS[kind])}, 'g')"
    # counts are taken on the progressively redacted text, as in Spark
    return f"SELECT doc_id, {t} AS text, {', '.join(cols)} FROM documents"


@register("pii_redact", _pii_sql())
def q_pii_redact(spark, sf_dir):
    return clean.pii_redact(docs(spark, sf_dir).select("doc_id", "text"))


@register("secret_redact", f"""
SELECT doc_id, regexp_replace(text, {O.q(tx.SECRET_RE)}, {O.q(tx.SECRET_TOKEN)}, 'g') AS text,
       {O.rx_count('text', tx.SECRET_RE)} AS n_secret FROM documents""")
def q_secret_redact(spark, sf_dir):
    return clean.secret_redact(docs(spark, sf_dir).select("doc_id", "text"))


@register("decontaminate", f"""
WITH m AS (SELECT dg.doc_id, count(DISTINCT bg.item_id) AS n
           FROM ({O.ngrams_sql('documents', 'doc_id', 13)}) dg
           JOIN ({O.ngrams_sql('benchmark', 'item_id', 13)}) bg USING (g) GROUP BY dg.doc_id)
SELECT d.doc_id, coalesce(m.n, 0) > 0 AS contaminated, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items
FROM documents d LEFT JOIN m USING (doc_id)""")
def q_decontaminate(spark, sf_dir):
    from corpusmill.operators.decontam import decontaminate
    return decontaminate(docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_FUNNEL_SQL = f"""
WITH raw AS (SELECT doc_id, lang, source, text FROM documents),
s1 AS (SELECT * FROM raw WHERE length(text) BETWEEN 200 AND 100000 AND {O.word_count('text')} >= 50),
s2 AS (SELECT * FROM s1 WHERE doc_id IN (SELECT doc_id FROM ({O.quality_filter_sql('s1')}) WHERE keep)),
s3 AS (SELECT * FROM s2 WHERE doc_id IN (SELECT min(doc_id) FROM s2 GROUP BY {O.dedup_key('text')})),
u AS (SELECT 0 AS stage_ix, 'raw' AS stage, lang, source, strlen(text) AS b FROM raw
      UNION ALL SELECT 1, 'length', lang, source, strlen(text) FROM s1
      UNION ALL SELECT 2, 'quality', lang, source, strlen(text) FROM s2
      UNION ALL SELECT 3, 'exact_dedup', lang, source, strlen(text) FROM s3),
a AS (SELECT stage_ix, stage, lang, source, CAST(count(*) AS BIGINT) AS rows, CAST(sum(b) AS BIGINT) AS bytes,
             GROUPING(stage_ix, stage, lang, source) AS gid
      FROM u GROUP BY ROLLUP (stage_ix, stage, lang, source))
SELECT stage, lang, source, rows, bytes,
       CAST(coalesce(lag(rows) OVER (PARTITION BY lang, source, gid ORDER BY stage_ix) - rows, 0) AS BIGINT) AS dropped
FROM a WHERE stage IS NOT NULL AND gid IN (0, 1, 3)"""


def funnel_stages(d: DataFrame):
    raw = d.select("doc_id", "lang", "source", "text")
    s1 = clean.length_filter(raw)
    s2 = clean.annotate_quality(s1).where("keep").select(*raw.columns)
    s3 = dedup.exact_dedup(s2)
    return [("raw", raw), ("length", s1), ("quality", s2), ("exact_dedup", s3)]


@register("clean_funnel", _FUNNEL_SQL)
def q_clean_funnel(spark, sf_dir):
    return clean.standard_funnel(docs(spark, sf_dir))


@register("rule_calibration", f"""
WITH j AS (SELECT q.keep, l.quality, d.lang FROM ({O.quality_filter_sql()}) q
           JOIN labels l USING (doc_id) JOIN documents d USING (doc_id)),
a AS (SELECT lang, CAST(sum(CASE WHEN keep AND quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN keep AND quality <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN NOT keep AND quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN NOT keep AND quality <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM j GROUP BY lang)
SELECT lang, tp, fp, fn, tn, {O.ratio('tp', 'tp + fp')} AS precision, {O.ratio('tp', 'tp + fn')} AS recall FROM a""")
def q_rule_calibration(spark, sf_dir):
    d = docs(spark, sf_dir)
    decisions = clean.quality_filter(clean.quality_stats(d))
    return clean.rule_calibration(decisions, table(spark, sf_dir, "labels"), d)


# ---------------------------------------------------------------------------
# Near duplicates and duplicate-aware splits
# ---------------------------------------------------------------------------

@register("near_dup_pairs")
def q_near_dup_pairs(spark, sf_dir):
    """Every pair of Jaccard 0.8 or more, a row each; checked against brute force in tests/."""
    return dedup.near_dup_pairs(docs(spark, sf_dir), every=True)


@register("near_dup_members", f"""
SELECT DISTINCT doc_id FROM (SELECT a AS doc_id FROM ({O.near_pairs_sql()}) UNION ALL
                             SELECT b FROM ({O.near_pairs_sql()}))""")
def q_near_dup_members(spark, sf_dir):
    """Documents with at least one near duplicate: the endpoints of B8's verified edges.

    Every edge is a verified pair; a document with a partner is found if they
    meet in a band bucket, for which MinHash gives a probability (1 - (1 - j^4)^32), not a proof.
    """
    e = dedup.near_dup_pairs(docs(spark, sf_dir))
    return e.select(F.col("a").alias("doc_id")).unionByName(e.select(F.col("b").alias("doc_id"))).distinct()


@register("near_dedup", f"SELECT doc_id FROM ({O.near_only_components_sql()}) WHERE doc_id = component")
def q_near_dedup(spark, sf_dir):
    d = docs(spark, sf_dir)
    return dedup.near_dedup(d, dedup.near_dup_pairs(d)).select("doc_id")


@register("dup_components", O.components_sql())
def q_dup_components(spark, sf_dir):
    return dedup.dup_components(docs(spark, sf_dir))


_CLUSTER_SPLIT_SQL = f"""
SELECT doc_id, component, CASE WHEN {O.bucket('component', 43)} % 10000 < 100 THEN 'validation' ELSE 'train' END AS split
FROM ({O.components_sql()})"""


@register("cluster_split", _CLUSTER_SPLIT_SQL)
def q_cluster_split(spark, sf_dir):
    d = docs(spark, sf_dir)
    return sample.cluster_split(d, dedup.dup_components(d)).select("doc_id", "component", "split")


@register("split_report", f"""
WITH s AS (SELECT doc_id, {SPLIT_SQL} AS split, strlen(text) AS b, {O.dedup_key('text')} AS k FROM documents),
c AS (SELECT * FROM s JOIN ({O.components_sql()}) USING (doc_id)),
ks AS (SELECT k, count(DISTINCT split) AS ns FROM s GROUP BY k),
cs AS (SELECT component, count(DISTINCT split) AS nc FROM c GROUP BY component)
SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(b) AS BIGINT) AS bytes,
       CAST(sum(CASE WHEN ns > 1 THEN 1 ELSE 0 END) AS BIGINT) AS cross_exact,
       CAST(sum(CASE WHEN nc > 1 THEN 1 ELSE 0 END) AS BIGINT) AS cross_near
FROM c JOIN ks USING (k) JOIN cs USING (component) GROUP BY split""")
def q_split_report(spark, sf_dir):
    d = docs(spark, sf_dir)
    return sample.split_report(sample.split(d, 0.01, 43), dedup.dup_components(d))


# ---------------------------------------------------------------------------
# Budget and stratified samples
# ---------------------------------------------------------------------------

BUDGET_BYTES = 2_000_000


@register("budget_sample", f"""
SELECT doc_id FROM (SELECT doc_id, sum(strlen(text)) OVER (ORDER BY {O.bucket('doc_id', 42)}, doc_id
                                                          ROWS UNBOUNDED PRECEDING) AS cum FROM documents)
WHERE cum <= {BUDGET_BYTES}""")
def q_budget_sample(spark, sf_dir):
    return sample.budget_sample(docs(spark, sf_dir), BUDGET_BYTES, 42).select("doc_id")


@register("stratified_sample", f"""
SELECT doc_id, lang, source FROM (
  SELECT doc_id, lang, source,
         row_number() OVER (PARTITION BY lang, source ORDER BY {O.bucket('doc_id', 42)}, doc_id) AS rn,
         count(*) OVER (PARTITION BY lang, source) AS n
  FROM documents)
WHERE rn <= ceil(CAST(n AS DOUBLE) * 0.1 - 1e-9)""")
def q_stratified_sample(spark, sf_dir):
    return sample.stratified_sample(docs(spark, sf_dir), ("lang", "source"), 0.10, 42).select("doc_id", "lang", "source")


# ---------------------------------------------------------------------------
# Index, batches, collation, training schedule
# ---------------------------------------------------------------------------

INDEXED_SQL = O.indexed_windows_sql(ENCODED_SQL)


def _indexed(spark, sf_dir):
    d = docs(spark, sf_dir)
    return W.ordered_windows(d, encode.WordTokenizer(encode.word_vocab(d)))


def _index(spark, sf_dir):
    """The windows' index without their tokens."""
    return W.window_index(_encoded(spark, sf_dir))


@register("sample_index", f"SELECT doc_id, window_ix, n_tokens, sample_id FROM ({INDEXED_SQL})")
def q_sample_index(spark, sf_dir):
    return _index(spark, sf_dir)


_BATCH_COLS = "sample_id, CAST(sample_id // 64 AS BIGINT) AS batch_id, CAST(sample_id % 64 AS INTEGER) AS pos"


@register("batches", f"SELECT doc_id, window_ix, {_BATCH_COLS} FROM ({INDEXED_SQL})")
def q_batches(spark, sf_dir):
    return W.batches(_index(spark, sf_dir)).select("doc_id", "window_ix", "sample_id", "batch_id", "pos")


@register("worker_shards", f"""
SELECT batch_id, CAST(batch_id % 4 AS INTEGER) AS shard, CAST(count(*) AS BIGINT) AS samples
FROM (SELECT {_BATCH_COLS} FROM ({INDEXED_SQL})) GROUP BY batch_id""")
def q_worker_shards(spark, sf_dir):
    b = W.worker_shards(W.batches(_index(spark, sf_dir)))
    return b.groupBy("batch_id", "shard").agg(F.count(F.lit(1)).cast("bigint").alias("samples"))


_COLLATED_SQL = f"""
SELECT {_BATCH_COLS}, n_tokens,
       list_transform(range(512), lambda i: CASE WHEN i < n_tokens THEN wids[i + 1] ELSE 0 END) AS ids,
       list_transform(range(512), lambda i: CASE WHEN i < n_tokens THEN 1 ELSE 0 END) AS mask,
       list_transform(range(512), lambda i: CASE WHEN i < n_tokens THEN wids[i + 1] ELSE -100 END) AS labels
FROM ({INDEXED_SQL})"""


def _collated(spark, sf_dir):
    return W.lm_labels(W.collate(W.batches(_indexed(spark, sf_dir))))


@register("collate", f"SELECT batch_id, pos, {O.ids_text('ids')} AS input_ids, {O.ids_text('mask')} AS attention_mask "
                     f"FROM ({_COLLATED_SQL})")
def q_collate(spark, sf_dir):
    c = _collated(spark, sf_dir)
    return c.select("batch_id", "pos", tx.ids_text("input_ids").alias("input_ids"),
                    tx.ids_text("attention_mask").alias("attention_mask"))


@register("lm_labels", f"SELECT batch_id, pos, {O.ids_text('labels')} AS labels FROM ({_COLLATED_SQL})")
def q_lm_labels(spark, sf_dir):
    return _collated(spark, sf_dir).select("batch_id", "pos", tx.ids_text("labels").alias("labels"))


_BATCH_INDEX_SQL = f"SELECT DISTINCT CAST(sample_id // 64 AS BIGINT) AS batch_id FROM ({INDEXED_SQL})"


def _batch_index(spark, sf_dir):
    return W.batches(_index(spark, sf_dir)).select("batch_id").distinct()


@register("epochs", f"SELECT CAST(e AS INTEGER) AS epoch, batch_id FROM ({_BATCH_INDEX_SQL}), range(6) t(e)")
def q_epochs(spark, sf_dir):
    return W.epochs(_batch_index(spark, sf_dir)).select(F.col("epoch").cast("int"), "batch_id")


@register("accum_groups", f"SELECT batch_id, CAST(batch_id // 8 AS BIGINT) AS step FROM ({_BATCH_INDEX_SQL})")
def q_accum_groups(spark, sf_dir):
    return W.accum_groups(_batch_index(spark, sf_dir))


@register("val_subset", f"""
SELECT doc_id, window_ix, {_BATCH_COLS} FROM ({O.indexed_windows_sql(O.word_encode_sql(
    src=f"(SELECT * FROM documents WHERE {SPLIT_SQL} = 'validation')", vocab_src='documents'))})
WHERE sample_id // 64 < 5000""")
def q_val_subset(spark, sf_dir):
    d = docs(spark, sf_dir)
    val = sample.split(d, 0.01, 43).where(F.col("split") == "validation")
    enc = encode.word_encode(val, encode.word_vocab(d))
    b = W.batches(W.window_index(enc))
    from corpusmill.operators.sample import val_subset
    return val_subset(b, 5000).select("doc_id", "window_ix", "sample_id", "batch_id", "pos")


@register("training_budget", f"""
WITH s AS (SELECT {SPLIT_SQL} AS split, {O.word_count('text')} AS n FROM documents),
c AS (SELECT split, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS tokens,
             CAST(sum({O.window_count('n')}) AS BIGINT) AS samples FROM s GROUP BY split),
b AS (SELECT *, CAST((samples + 63) // 64 AS BIGINT) AS batches FROM c),
p AS (SELECT *, CAST((batches + 7) // 8 AS BIGINT) AS steps_per_epoch FROM b)
SELECT split, documents, tokens, samples, batches, steps_per_epoch,
       CAST(steps_per_epoch * 6 AS BIGINT) AS total_steps,
       CAST((steps_per_epoch * 6) // 6 AS BIGINT) AS log_events,
       CAST((steps_per_epoch * 6) // 1250 AS BIGINT) AS save_events,
       CAST(CASE WHEN split = 'validation' THEN least(batches, 5000) ELSE 0 END AS BIGINT) AS eval_batches
FROM p""")
def q_training_budget(spark, sf_dir):
    d = sample.split(docs(spark, sf_dir), 0.01, 43)
    return W.training_budget(d.select("split", tx.word_count("text").alias("n_tokens")))


@register("padding_report", f"""
SELECT CAST(count(*) AS BIGINT) AS windows, CAST(sum(n_tokens) AS BIGINT) AS real_tokens,
       CAST(sum(512 - n_tokens) AS BIGINT) AS pad_tokens,
       CAST(sum(CASE WHEN window_ix > 0 THEN least(n_tokens, 128) ELSE 0 END) AS BIGINT) AS overlap_tokens,
       CAST(sum(CASE WHEN n_tokens = 512 THEN 1 ELSE 0 END) AS BIGINT) AS full_windows,
       CAST(sum(CASE WHEN n_tokens < 512 THEN 1 ELSE 0 END) AS BIGINT) AS short_windows
FROM ({O.windows_sql(ENCODED_SQL)})""")
def q_padding_report(spark, sf_dir):
    return W.padding_report(W.windows(_encoded(spark, sf_dir)))


@register("window_histogram", f"""
SELECT CAST(n_tokens // 64 * 64 AS BIGINT) AS from_tokens, CAST(count(*) AS BIGINT) AS windows, CAST(sum(n_tokens) AS BIGINT) AS tokens
FROM ({O.windows_sql(ENCODED_SQL)}) GROUP BY 1""")
def q_window_histogram(spark, sf_dir):
    return W.window_histogram(W.windows(_encoded(spark, sf_dir)))


# ---------------------------------------------------------------------------
# D: byte-level BPE
# ---------------------------------------------------------------------------

@register("pair_counts", f"""
WITH w AS (SELECT word, count(*) AS n, hex(encode(word)) AS h
           FROM (SELECT unnest(regexp_extract_all(text, {O.q(tx.PRETOKEN_RE)})) AS word FROM documents) GROUP BY word)
SELECT CAST(('0x' || substr(h, 2 * i + 1, 2)) AS INTEGER) + 3 AS left_id,
       CAST(('0x' || substr(h, 2 * i + 3, 2)) AS INTEGER) + 3 AS right_id, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT h, n, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 1)) AS i FROM w) GROUP BY 1, 2""")
def q_pair_counts(spark, sf_dir):
    from corpusmill.operators import bpe
    return bpe.pair_counts(bpe.word_symbols(bpe.pretoken_counts(docs(spark, sf_dir))))


_TOKENIZERS: dict = {}


def _trained(spark, sf_dir):
    """(vocab, merges) of the default vocabulary, trained on the documents.

    Encode-side queries share the artifact (at most a vocabulary's rows), the way a
    trainer hands one tokenizer.json to every consumer; it is known by the texts it
    was trained on, so another or a rewritten table is trained anew.
    """
    from corpusmill.operators import bpe
    d = docs(spark, sf_dir)
    h = F.xxhash64("text").cast("decimal(38,0)")
    key = (spark.sparkContext.applicationId, *d.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.octet_length("text"))).first())
    if key in _TOKENIZERS:
        merges = _TOKENIZERS[key]
        return bpe.vocab_table(spark, merges), bpe.merges_table(spark, merges)
    vocab, m = bpe.train_bpe(d)
    _TOKENIZERS[key] = [(r["left_id"], r["right_id"], r["new_id"]) for r in m.orderBy("rank").collect()]
    return vocab, m


@register("train_bpe")
def q_train_bpe(spark, sf_dir):
    """Merge list of exact batched BPE at 25,000 ids (checked against sequential BPE in tests/)."""
    return _trained(spark, sf_dir)[1]


def _saved_tokenizer(spark, sf_dir):
    """Path of the default tokenizer, saved: vocab and merges tables and tokenizer.json."""
    from corpusmill.operators import bpe
    from corpusmill.session import scratch_path
    vocab, merges = _trained(spark, sf_dir)
    path = scratch_path(spark, "tokenizer")
    bpe.save_tokenizer(vocab, merges, path)
    return path


@register("tokenizer_tables")
def q_tokenizer_tables(spark, sf_dir):
    """The vocabulary table of the saved tokenizer (specials, byte alphabet, merges) with token bytes as hex."""
    vocab = spark.read.parquet(f"{_saved_tokenizer(spark, sf_dir)}/vocab")
    return vocab.select("token_id", F.hex("token").alias("token_hex"), "kind")


@register("tokenizer_json")
def q_tokenizer_json(spark, sf_dir):
    """The merges as they are read back from the saved tokenizer.json."""
    from corpusmill.operators import bpe
    return bpe.merges_table(spark, bpe.load_tokenizer(spark, _saved_tokenizer(spark, sf_dir)).merges)


@register("bpe_encode", "SELECT doc_id, text FROM documents")
def q_bpe_encode(spark, sf_dir):
    """decode(encode(text)) for every document - must reproduce the text exactly."""
    from corpusmill.operators import bpe
    d = docs(spark, sf_dir)
    vocab, merges = _trained(spark, sf_dir)
    return bpe.bpe_decode(bpe.bpe_encode(d, merges), vocab)


@register("bpe_collate", "SELECT doc_id, text FROM documents WHERE length(text) > 0")
def q_bpe_collate(spark, sf_dir):
    """The reference's own path, and back: documents -> BPE ids of the saved tokenizer -> overlapping windows with sample
    ids -> batches -> padded with mask and labels; then the labels' real tokens, overlaps taken out, decoded to the texts."""
    from corpusmill.operators import bpe
    tok = bpe.load_tokenizer(spark, _saved_tokenizer(spark, sf_dir))
    batched = W.lm_labels(W.collate(W.batches(W.ordered_windows(docs(spark, sf_dir), tok))))
    real = F.filter("labels", lambda x: x != tx.IGNORE_ID)
    back = W.unwindowed(batched.select("doc_id", "window_ix", "n_tokens", real.alias("input_ids")))
    return bpe.bpe_decode(back, bpe.vocab_table(spark, tok.merges))


@register("bpe_sample_index")
def q_bpe_sample_index(spark, sf_dir):
    """E5 under BPE: the dense index of all samples (tests: equals the encoder of the tokenizers library)."""
    from corpusmill.operators import bpe
    tok = bpe.load_tokenizer(spark, _saved_tokenizer(spark, sf_dir))
    return W.window_index(tok.encode_df(docs(spark, sf_dir))).select("doc_id", "window_ix", "n_tokens", "sample_id")


@register("vocab_report")
def q_vocab_report(spark, sf_dir):
    from corpusmill.operators import bpe
    d = docs(spark, sf_dir)
    _, merges = _trained(spark, sf_dir)
    return bpe.vocab_report(bpe.bpe_encode(d, merges), d)


@register("top_tokens", f"""
SELECT token_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(ids) AS token_id FROM ({ENCODED_SQL}))
GROUP BY token_id ORDER BY n DESC, token_id LIMIT 100""")
def q_top_tokens(spark, sf_dir):
    """The 100 most frequent token ids under the word encoder, with their words' bytes looked up by id."""
    from corpusmill.operators import bpe
    d = docs(spark, sf_dir)
    vocab = encode.word_vocab(d)
    named = vocab.select("token_id", F.encode("word", "UTF-8").alias("token")).unionByName(
        bpe.special_tokens(spark).select("token_id", "token"))
    return bpe.top_tokens(encode.word_encode(d, vocab), named).select("token_id", "n")


@register("word_vocab_report", f"""
SELECT d.lang, CAST(sum(e.n_tokens) AS BIGINT) AS tokens, CAST(sum({O.word_count('d.text')}) AS BIGINT) AS words,
  {O.ratio('sum(e.n_tokens)', f"sum({O.word_count('d.text')})")} AS tokens_per_word,
  {O.ratio('sum(octet_length(encode(d.text)))', 'sum(e.n_tokens)')} AS bytes_per_token
FROM documents d JOIN ({ENCODED_SQL}) e ON d.doc_id = e.doc_id GROUP BY d.lang""")
def q_word_vocab_report(spark, sf_dir):
    """D8 under the word encoder."""
    from corpusmill.operators import bpe
    return bpe.vocab_report(_encoded(spark, sf_dir), docs(spark, sf_dir))


# ---------------------------------------------------------------------------
# F: instruction (SFT) data
# ---------------------------------------------------------------------------

_PAIRS_SQL = """
SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(s.text, '') AS input, u.next_text AS output
FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) u
LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
WHERE u.role = 'user' AND u.next_role = 'assistant'"""

_FILTERED_SQL = f"""
SELECT conv_id, turn, instruction, input, output FROM (
  SELECT *, row_number() OVER (PARTITION BY instruction, input, output ORDER BY conv_id, turn) AS rn
  FROM ({_PAIRS_SQL}) WHERE trim(instruction) <> '' AND trim(output) <> '') WHERE rn = 1"""


def _prompt_sql(tpl_in: str, tpl_no: str) -> str:
    def fill(tpl, with_input):
        a, rest = tpl.split("{instruction}")
        if with_input:
            b, c = rest.split("{input}")
            return f"{O.q(a)} || instruction || {O.q(b)} || input || {O.q(c)}"
        return f"{O.q(a)} || instruction || {O.q(rest)}"
    return f"CASE WHEN input <> '' THEN {fill(tpl_in, True)} ELSE {fill(tpl_no, False)} END"


def _sft_records(spark, sf_dir):
    from corpusmill.operators import sft
    return sft.sft_prompt(sft.sft_filter(sft.sft_pairs(table(spark, sf_dir, "conversations"))))


def _sft_encoded(spark, sf_dir):
    from corpusmill.operators import sft
    vocab = encode.word_vocab(docs(spark, sf_dir))
    return sft.sft_encode(_sft_records(spark, sf_dir), encode.WordTokenizer(vocab))


@register("sft_pairs", _PAIRS_SQL)
def q_sft_pairs(spark, sf_dir):
    from corpusmill.operators import sft
    return sft.sft_pairs(table(spark, sf_dir, "conversations"))


@register("sft_filter", _FILTERED_SQL)
def q_sft_filter(spark, sf_dir):
    from corpusmill.operators import sft
    return sft.sft_filter(sft.sft_pairs(table(spark, sf_dir, "conversations")))


def _prompt_expr_sql():
    from corpusmill.operators import sft
    return _prompt_sql(sft.PROMPT_WITH_INPUT, sft.PROMPT_NO_INPUT)


@register("sft_prompt", f"SELECT conv_id, turn, {_prompt_expr_sql()} AS prompt FROM ({_FILTERED_SQL})")
def q_sft_prompt(spark, sf_dir):
    return _sft_records(spark, sf_dir).select("conv_id", "turn", "prompt")


_RECORDS_SQL = f"SELECT *, conv_id * 1000000 + turn AS rid, {_prompt_expr_sql()} AS prompt FROM ({_FILTERED_SQL})"
_SFT_ENC_SQL = f"""
SELECT r.conv_id, r.turn, CAST(len(p.ids) AS BIGINT) AS prompt_tokens, CAST(len(o.ids) + 1 AS BIGINT) AS response_tokens,
       list_slice(list_concat(list_concat(p.ids, o.ids), [2]), 1, 512) AS ids,
       list_slice(list_concat(list_concat(list_transform(p.ids, lambda x: -100), o.ids), [2]), 1, 512) AS labels
FROM ({_RECORDS_SQL}) r
JOIN ({O.word_encode_sql(src=f"(SELECT rid, prompt AS text FROM ({_RECORDS_SQL}))", vocab_src='documents', id_col='rid')}) p USING (rid)
JOIN ({O.word_encode_sql(src=f"(SELECT rid, output AS text FROM ({_RECORDS_SQL}))", vocab_src='documents', id_col='rid')}) o USING (rid)
WHERE len(p.ids) < 512"""


@register("sft_encode", f"""
SELECT conv_id, turn, prompt_tokens, response_tokens, CAST(len(ids) AS BIGINT) AS n_tokens,
       {O.ids_text('ids')} AS input_ids, {O.ids_text('labels')} AS labels FROM ({_SFT_ENC_SQL})""")
def q_sft_encode(spark, sf_dir):
    e = _sft_encoded(spark, sf_dir)
    return e.select("conv_id", "turn", "prompt_tokens", "response_tokens", "n_tokens",
                    tx.ids_text("input_ids").alias("input_ids"), tx.ids_text("labels").alias("labels"))


@register("bpe_sft", f"SELECT conv_id, turn, {_prompt_expr_sql()} AS prompt, output FROM ({_FILTERED_SQL})")
def q_bpe_sft(spark, sf_dir):
    """F4 with the saved BPE tokenizer, uncut, and back: what the labels hide decodes to the prompt, the rest to the output."""
    from corpusmill.operators import bpe, sft
    tok = bpe.load_tokenizer(spark, _saved_tokenizer(spark, sf_dir))
    enc = sft.sft_encode(_sft_records(spark, sf_dir), tok, max_seq_length=1 << 30)
    at = F.col("prompt_tokens").cast("int")
    response = F.filter("labels", lambda x: (x != tx.IGNORE_ID) & (x != tx.EOS_ID))
    both = enc.select(F.struct("conv_id", "turn").alias("doc_id"), F.explode(F.array(
        F.struct(F.lit("prompt").alias("part"), F.slice("input_ids", 1, at).alias("input_ids")),
        F.struct(F.lit("output").alias("part"), response.alias("input_ids")))).alias("x"))
    text = bpe.bpe_decode(both.select(F.struct("doc_id", "x.part").alias("doc_id"), "x.input_ids"), bpe.vocab_table(spark, tok.merges))
    return (text.select("doc_id.doc_id.*", "doc_id.part", "text").groupBy("conv_id", "turn")
                .agg(F.max(F.when(F.col("part") == "prompt", F.col("text"))).alias("prompt"),
                     F.max(F.when(F.col("part") == "output", F.col("text"))).alias("output")))


@register("sft_batches", f"""
SELECT CAST(sid // 64 AS BIGINT) AS batch_id, CAST(sid % 64 AS INTEGER) AS pos,
       {O.ids_text("list_transform(range(512), lambda i: CASE WHEN i < len(ids) THEN ids[i + 1] ELSE 0 END)")} AS input_ids,
       {O.ids_text("list_transform(range(512), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END)")} AS attention_mask,
       {O.ids_text("list_transform(range(512), lambda i: CASE WHEN i < len(labels) THEN labels[i + 1] ELSE -100 END)")} AS labels
FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS sid FROM ({_SFT_ENC_SQL}))""")
def q_sft_batches(spark, sf_dir):
    from corpusmill.operators import sft
    b = sft.sft_batches(_sft_encoded(spark, sf_dir))
    return b.select("batch_id", "pos", tx.ids_text("input_ids").alias("input_ids"),
                    tx.ids_text("attention_mask").alias("attention_mask"), tx.ids_text("labels").alias("labels"))


def _report_sql() -> str:
    base = f"SELECT * FROM ({_SFT_ENC_SQL})"
    parts = [f"SELECT 'records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ({base})",
             f"SELECT 'conversations', CAST(count(DISTINCT conv_id) AS DOUBLE) FROM ({base})",
             f"SELECT 'turns', CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT conv_id, turn FROM ({base}))",
             f"SELECT 'truncated', CAST(sum(CASE WHEN prompt_tokens + response_tokens > 512 THEN 1 ELSE 0 END) AS DOUBLE) FROM ({base})",
             f"SELECT 'truncated_share', {O.ratio('sum(CASE WHEN prompt_tokens + response_tokens > 512 THEN 1 ELSE 0 END)', 'count(*)')} FROM ({base})"]
    for c in ("prompt_tokens", "response_tokens"):
        for p in (50, 90):
            parts.append(f"SELECT '{c}_p{p}', round(quantile_cont({c}, {p / 100}), 6) FROM ({base})")
    return " UNION ALL ".join(parts)


@register("sft_report", _report_sql())
def q_sft_report(spark, sf_dir):
    from corpusmill.operators import sft
    return sft.sft_report(_sft_encoded(spark, sf_dir))


# ---------------------------------------------------------------------------
# A: formats and sinks (each writes under the shared checkpoint dir and reads back)
# ---------------------------------------------------------------------------

_DOC_COLS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


@register("read_arrow", _DOC_COLS)
def q_read_arrow(spark, sf_dir):
    """Round trip documents through Arrow IPC files with the arrow_ipc data source."""
    from corpusmill.session import scratch_path
    from corpusmill.sources.arrow_ipc import register as reg
    from corpusmill.sources.corpus import read_corpus
    reg(spark)
    path = scratch_path(spark, "arrow")
    docs(spark, sf_dir).write.format("arrow_ipc").mode("overwrite").save(path)
    return read_corpus(spark, path, fmt="arrow").select("doc_id", "text", "lang", "source", "n_chars")


@register("write_splits", f"SELECT doc_id, {SPLIT_SQL} AS split FROM documents")
def q_write_splits(spark, sf_dir):
    """C2 split written partitioned by split, read back (partition pruning on read)."""
    from corpusmill.session import scratch_path
    from corpusmill.sources.corpus import read_splits, write_splits
    path = scratch_path(spark, "splits")
    write_splits(sample.split(docs(spark, sf_dir), 0.01, 43), path)
    return read_splits(spark, path).select("doc_id", "split")


@register("read_instructions", _FILTERED_SQL.replace("SELECT conv_id, turn, instruction, input, output FROM (",
                                                     "SELECT instruction, input, output FROM (", 1))
def q_read_instructions(spark, sf_dir):
    """F1+F2 records written as Alpaca JSON, read back with the Alpaca reader."""
    from corpusmill.operators import sft
    from corpusmill.session import scratch_path
    from corpusmill.sources.corpus import read_alpaca, write_alpaca
    path = scratch_path(spark, "alpaca")
    write_alpaca(sft.sft_filter(sft.sft_pairs(table(spark, sf_dir, "conversations"))), path)
    return read_alpaca(spark, path)


@register("write_batches", f"""
SELECT batch_id, pos, {O.ids_text('ids')} AS input_ids, {O.ids_text('mask')} AS attention_mask FROM ({_COLLATED_SQL})""")
def q_write_batches(spark, sf_dir):
    from corpusmill.session import scratch_path
    from corpusmill.sources.corpus import write_batches
    path = scratch_path(spark, "batches")
    write_batches(_collated(spark, sf_dir).select("batch_id", "pos", "input_ids", "attention_mask"), path)
    b = spark.read.parquet(path)
    return b.select("batch_id", "pos", tx.ids_text("input_ids").alias("input_ids"),
                    tx.ids_text("attention_mask").alias("attention_mask"))


# ---------------------------------------------------------------------------
# G: streaming (availableNow over the documents, one file or a folder of them, then read the sink)
# ---------------------------------------------------------------------------

def _doc_stream(spark, sf_dir):
    from corpusmill.streaming.streams import stream_corpus
    return stream_corpus(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


@register("stream_docs", _DOC_COLS)
def q_stream_docs(spark, sf_dir):
    from corpusmill.session import scratch_path
    out, ck = scratch_path(spark, "stream-docs"), scratch_path(spark, "stream-docs-ck")
    q = _doc_stream(spark, sf_dir).writeStream.format("parquet").option("checkpointLocation", ck) \
        .trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.parquet(out)


def _clean_sql() -> str:
    t = O.strip_control("text")
    t = O.normalize(t)
    t = f"array_to_string(list_filter(string_split({t}, chr(10)), lambda l: NOT regexp_matches(l, {O.q(tx.LICENSE_RE)})), chr(10))"
    for kind in tx.PII_KINDS:
        t = f"regexp_replace({t}, {O.q(tx.PII_PATTERNS[kind])}, {O.q(tx.PII_TOKENS[kind])}, 'g')"
    t = f"regexp_replace({t}, {O.q(tx.SECRET_RE)}, {O.q(tx.SECRET_TOKEN)}, 'g')"
    return f"""
WITH c AS (SELECT doc_id, {t} AS text FROM documents),
f AS (SELECT * FROM c WHERE length(text) BETWEEN 200 AND 100000 AND {O.word_count('text')} >= 50)
SELECT doc_id, text FROM f WHERE doc_id IN (SELECT doc_id FROM ({O.quality_filter_sql('f')}) WHERE keep)"""


@register("stream_clean", _clean_sql())
def q_stream_clean(spark, sf_dir):
    from corpusmill.session import scratch_path
    from corpusmill.streaming.streams import stream_clean
    out, ck = scratch_path(spark, "stream-clean"), scratch_path(spark, "stream-clean-ck")
    stream_clean(_doc_stream(spark, sf_dir), out, ck,
                 spread_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "text")


@register("stream_windows", f"""
SELECT doc_id, window_ix, n_tokens, {O.ids_text('wids')} AS input_ids
FROM ({O.windows_sql(O.word_encode_sql(src=f"({_clean_sql()})", vocab_src='documents'))})""")
def q_stream_windows(spark, sf_dir):
    from corpusmill.operators.joins import materialize
    from corpusmill.session import scratch_path
    from corpusmill.streaming.streams import stream_windows
    tok = encode.WordTokenizer(materialize(encode.word_vocab(docs(spark, sf_dir))))
    out, ck = scratch_path(spark, "stream-win"), scratch_path(spark, "stream-win-ck")
    stream_windows(_doc_stream(spark, sf_dir), tok, out, ck).awaitTermination()
    w = spark.read.parquet(out)
    return w.select("doc_id", "window_ix", "n_tokens", tx.ids_text("input_ids").alias("input_ids"))


@register("stream_dedup", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {O.dedup_key('text')}")
def q_stream_dedup(spark, sf_dir):
    from corpusmill.session import scratch_path
    from corpusmill.streaming.streams import stream_dedup
    seen, out, ck = (scratch_path(spark, "seen"), scratch_path(spark, "stream-dedup"),
                     scratch_path(spark, "stream-dedup-ck"))
    stream_dedup(_doc_stream(spark, sf_dir), seen, out, ck).awaitTermination()
    return spark.read.parquet(out).select("doc_id")


@register("stream_sample_count", f"""
SELECT lang, CAST(count(*) AS BIGINT) AS documents, CAST(sum({O.word_count('text')}) AS BIGINT) AS tokens,
       CAST(sum({O.window_count(O.word_count('text'))}) AS BIGINT) AS samples FROM documents GROUP BY lang""")
def q_stream_sample_count(spark, sf_dir):
    from corpusmill.session import scratch_path
    from corpusmill.streaming.streams import stream_sample_count
    out, ck = scratch_path(spark, "stream-count"), scratch_path(spark, "stream-count-ck")
    stream_sample_count(_doc_stream(spark, sf_dir), out, ck).awaitTermination()
    return spark.read.parquet(out)


@register("stream_window_count", f"""
SELECT lang, CAST(count(*) AS BIGINT) AS documents, CAST(sum(e.n_tokens) AS BIGINT) AS tokens, CAST(sum({O.window_count('e.n_tokens')}) AS BIGINT) AS samples
FROM ({O.word_encode_sql(src=f"({_clean_sql()})", vocab_src='documents')}) e JOIN documents d ON e.doc_id = d.doc_id WHERE e.n_tokens > 0 GROUP BY lang""")
def q_stream_window_count(spark, sf_dir):
    """Two chained streams: documents -> cleaned, encoded windows -> running counts per language."""
    from corpusmill.operators.joins import materialize
    from corpusmill.session import scratch_path
    from corpusmill.streaming.streams import stream_window_count, stream_windows
    tok = encode.WordTokenizer(materialize(encode.word_vocab(docs(spark, sf_dir))))
    win, out = scratch_path(spark, "stream-win"), scratch_path(spark, "stream-win-count")
    stream_windows(_doc_stream(spark, sf_dir), tok, win, scratch_path(spark, "stream-win-ck")).awaitTermination()
    stream_window_count(spark, win, out, scratch_path(spark, "stream-win-count-ck")).awaitTermination()
    return spark.read.parquet(out)
