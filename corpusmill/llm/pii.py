"""Personal data: pattern spans, and terms that give them away.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers that the patterns find.  A term that keeps company with an entity
tells about it: the pointwise mutual information of term and entity, over the
whole corpus, measures by how many bits.  A term that tells nearly all of the
entity's own information content is removed, one that tells most of it is generalised,
wherever in the corpus it stands: away from its entity it gives it away just as well.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import arrow_type, fresh, matching, pieces, saved
from corpusmill.session import prepare

KINDS = ("email", "ip", "card", "phone")
MIN_DOCS = 3                  # independent documents in which a term has to stand with the entity
RUN = 5                       # words of a shingle, by which copies are told
COPY = 0.8                    # shared shingles of all, from which on a document is a copy
SKETCHES = 4                  # min-hashes that bring copies together
CHANCE = 0.01                 # pairs that chance may bring about among all that are tested
GENERALISE, REMOVE = 0.75, 0.9      # shares of the entity's information content
COUNTER = 200_000             # distinct words a task holds before it passes their counts on
SLOTS = 1 << 22               # hash slots that say which words may be disclosing terms
SMALL = 200_000               # rows of a table that is broadcast, at most

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"\w+")
NUMBER = re.compile(r"[0-9]+")


def emails(text: str):
    """Leftmost matches, found from each @ outwards (a scan from the left would be quadratic in long runs)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str):
    """Four dotted numbers at a time of every dotted run."""
    for m in DOTTED.finditer(text):
        parts = [x.span() for x in NUMBER.finditer(text, m.start(), m.end())]
        for i in range(0, len(parts) - 3, 4):
            if all(e - s <= 3 or not text[s:e - 3].strip("0") for s, e in parts[i:i + 4]) and \
                    all(int(text[max(s, e - 3):e]) <= 255 for s, e in parts[i:i + 4]):
                yield parts[i][0], parts[i + 3][1]


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def cards(text: str):
    for m in DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 8 <= sum(map(len, NUMBER.findall(m.group()))) <= 15:
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if NUMBER.search(text):
        out += [(k, *s) for k in KINDS[1:] for s in FINDERS[k](text)]
    return out


def entity(kind: str, value: str) -> int:
    """What tells two mentions of one entity: the value less case and punctuation, hashed."""
    value = value.lower() if kind == "email" else ".".join(NUMBER.findall(value)) if kind == "ip" else "".join(NUMBER.findall(value))
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - (1 << 63)


def free_words(text: str, spans: list):
    """(lower-case word, start, end) of the words outside all spans, in order."""
    taken = sorted((s, e) for _, s, e in spans)
    i, reach = 0, 0                            # spans that start before the word's end, and how far they go
    for m in WORD.finditer(text):
        s, e = m.span()
        while i < len(taken) and taken[i][0] < e:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= s:
            yield m.group().lower(), s, e


def free_terms(text: str | None, spans: list) -> set:
    """The distinct words outside all spans."""
    if not spans:
        return set(map(str.lower, WORD.findall(text or "")))
    return {w for w, _, _ in free_words(text, spans)}


def run_hashes(text: str | None) -> np.ndarray:
    """Distinct hashes of the text's runs of ``RUN`` words (all words if there are fewer)."""
    words = WORD.findall((text or "").lower())
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    k = min(RUN, len(h))
    runs = np.zeros(len(h) - k + 1 if k else 0, np.uint64)
    for i in range(k):
        runs = (runs ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(32)
    return np.unique(runs).view(np.int64)


def sketch(runs: np.ndarray) -> list[int]:
    """``SKETCHES`` min-hashes of the runs."""
    if not len(runs):
        return [0] * SKETCHES
    x = runs.view(np.uint64)
    return [int(((x ^ np.uint64(0x5851F42D4C957F2D * (k + 1) % (1 << 64))) * np.uint64(0xC2B2AE3D27D4EB4F)).min().view(np.int64)) for k in range(SKETCHES)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the distinct entities and, where there are any, the distinct words of the whole text outside them, and what tells copies."""
    prepare(docs.sparkSession)
    schema = "text_hash bigint, ents array<bigint>, words array<string>, whole binary, marks array<bigint>"

    def run(batches):
        for b in pieces(batches, "text"):
            ents, words, whole, marks = [], [], [], []
            for t in b.column(1).to_pylist():
                spans = base_spans(t)
                ents.append(list({entity(k, t[s:e]) for k, s, e in spans}))
                words.append(list(free_terms(t, spans)) if spans else [])
                runs = run_hashes(t) if spans else np.zeros(0, np.int64)
                whole.append(hashlib.blake2b(runs.tobytes(), digest_size=16).digest() if spans else b"")
                marks.append(sketch(runs) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ents, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.string())), pa.array(whole, pa.binary()),
                 pa.array(marks, pa.list_(pa.int64()))], names=["text_hash", "ents", "words", "whole", "marks"])
    return docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def copies(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(whole) of the texts with entities that copy another such text: as evidence they say nothing new.

    Texts that agree in a min-hash are held against the first of them; those that share ``COPY`` of
    their runs or more with it are copies.  (Texts of equal runs share one ``whole``.)
    """
    texts = found.where(F.size("ents") > 0).groupBy("whole").agg(F.min("text_hash").alias("text_hash"), F.first("marks").alias("marks"))
    texts = saved(texts, "pii-texts")
    at = texts.select("whole", "text_hash", F.posexplode("marks").alias("k", "m"))
    first = at.groupBy("k", "m").agg(F.min(F.struct("whole", "text_hash")).alias("to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = saved(at.join(first, ["k", "m"]).where(F.col("whole") != F.col("to.whole"))
                  .select("whole", "text_hash", F.col("to.whole").alias("to"), F.col("to.text_hash").alias("to_hash")).distinct(), "pii-met")
    hashes = saved(met.select("text_hash").union(met.select("to_hash")).distinct(), "pii-met-hashes")

    def sets(batches):
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([run_hashes(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))],
                                             names=["text_hash", "runs"])
    src = docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    runs = saved(matching(src, hashes, "text_hash", "left_semi", SMALL).mapInArrow(sets, "text_hash bigint, runs array<bigint>")
                 .dropDuplicates(["text_hash"]), "pii-runs")
    both = F.size(F.array_intersect("runs", "others"))
    return saved(met.join(runs, "text_hash").join(runs.select(F.col("text_hash").alias("to_hash"), F.col("runs").alias("others")), "to_hash")
                    .where(both >= F.lit(COPY) * (F.size("runs") + F.size("others") - both)).select("whole").distinct(), "pii-copies")


def slot(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


def slots(terms: DataFrame) -> np.ndarray:
    """Bytes with a bit per hash slot, set where a term of ``terms(t)`` falls."""
    at = F.crc32(F.col("t").cast("binary")) % SLOTS
    bit = F.element_at(F.array(*[F.lit(1 << i).cast("bigint") for i in range(32)]), (at % 32 + 1).cast("int"))
    out = np.zeros(SLOTS // 32, "<u4")
    for r in terms.select(F.floor(at / 32).alias("i"), bit.alias("v")).groupBy("i").agg(F.bit_or("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.view(np.uint8)


def spotted(docs: DataFrame, bits: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, counts, base spans, their digest, and the words that may be disclosing (their slot is set)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, text_hash bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + \
        ", base string, base_sha256 string, seen array<struct<t:string,s:int,x:int>>"
    seen_type = pa.list_(pa.struct([("t", pa.string()), ("s", pa.int32()), ("x", pa.int32())]))
    some = bool(bits.any())

    def run(batches):
        known: dict = {}

        def held(w):
            if w not in known:
                if len(known) > COUNTER:
                    known.clear()
                i = slot(w)
                known[w] = bool(bits[i >> 3] >> (i & 7) & 1)
            return known[w]
        for b in pieces(batches, "text"):
            base, seen, counts = [], [], {k: [] for k in KINDS}
            for t in b.column(2).to_pylist():
                spans = base_spans(t)
                base.append(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
                hit = some and t and any(map(held, set(map(str.lower, WORD.findall(t)))))
                seen.append([{"t": w, "s": s, "x": e} for w, s, e in free_words(t, spans) if held(w)] if hit else [])
                for k in KINDS:
                    counts[k].append(sum(x[0] == k for x in spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(base, pa.string()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()), pa.array(seen, seen_type)],
                names=["doc_id", "text_hash", *[f"n_{k}" for k in KINDS], "base", "base_sha256", "seen"])
    return src.mapInArrow(run, schema)


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(t, n): number of documents that hold each lower-case word outside their entities, over all documents."""
    prepare(docs.sparkSession)

    def run(batches):
        count: dict = {}
        for b in pieces(batches, "text"):
            for t in b.column(0).to_pylist():
                for w in free_terms(t, base_spans(t)):
                    count[w] = count.get(w, 0) + 1
                if len(count) > COUNTER:
                    yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], names=["t", "n"])
                    count = {}
        yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], names=["t", "n"])
    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n"))


def disclosing(found: DataFrame, docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
               generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(e, t, share, level): terms and the share of the entity's information that they disclose.

    share = PMI(t, e) / IC(e) with document probabilities over the whole
    corpus; level 1 generalises, 2 removes.  An entity in every document has no
    information to protect.  Term and entity meet where one document holds both, however
    far apart.  Evidence has to come from ``min_docs`` independent documents or more: of equal texts and of near
    copies (``copies``) one counts.  And it has to be more than chance brings about in as many
    pairs as are tested (the Poisson tail of what independence lets expect): a word that merely fell
    together with an entity is left.
    As they meet in n_e documents at most, a term of more than
    N * (n_e / N) ** generalise documents cannot reach the share: such pairs are not formed.
    """
    found = saved(found.withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    total = found.count()
    n = F.lit(float(max(total, 1)))
    # One row stands for all copies of its text.
    firsts = found.where(F.size("ents") > 0).groupBy("whole").agg(F.min("row").alias("row"))
    lone = saved(firsts.join(copies(found, docs, text_col), "whole", "left_anti").select("row", F.lit(1).alias("lone")), "pii-independent")
    held = saved(found.where(F.size("ents") > 0).select("row", F.explode("ents").alias("e")).join(lone, "row", "left")
                      .select("row", "e", F.coalesce("lone", F.lit(0)).alias("lone")), "pii-mentions")
    ents = saved(held.groupBy("e").agg(F.count(F.lit(1)).alias("n_e"), F.sum("lone").alias("s_e"))
                     .where((F.col("s_e") >= min_docs) & (F.col("n_e") < total))
                     .withColumn("most", n * F.pow(F.col("n_e") / n, F.lit(float(generalise))) * (1 + 1e-9)), "pii-entities")
    most = ents.agg(F.max("most")).first()[0] or 0.0
    df = saved(term_counts(docs, text_col).where((F.col("n") >= min_docs) & (F.col("n") <= most)), "pii-df")
    held = saved(matching(held, ents, "e", "inner", SMALL), "pii-held")
    words = found.join(held.select("row").distinct(), "row", "left_semi").select("row", F.explode("words").alias("t"))
    meet = held.join(matching(words, df, "t", "inner", SMALL), "row").where(F.col("n") <= F.col("most"))
    joined = saved(meet.groupBy("e", "t", "n_e", "s_e", "n").agg(F.count(F.lit(1)).alias("n_et"), F.sum("lone").alias("s_et")), "pii-pairs")
    tested = joined.count()
    share = F.log2(F.col("n_et") * n / (F.col("n") * F.col("n_e"))) / F.log2(n / F.col("n_e"))
    by_chance = F.col("s_e") * F.col("n") / n
    tail = F.col("s_et") * F.log(F.col("s_et") / by_chance) - (F.col("s_et") - by_chance)
    sure = (F.col("s_et") > by_chance) & (tail >= F.log(F.lit(max(tested, 1) / CHANCE)))
    return saved(joined.where((F.col("s_et") >= min_docs) & sure).select("e", "t", share.alias("share")).where(F.col("share") >= generalise)
                 .withColumn("level", F.when(F.col("share") >= remove, 2).otherwise(1)), "pii-disclosing")


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_email, n_ip, n_card, n_phone, base, base_sha256, terms.

    base: the pattern spans as ``kind:start:end``; terms: array of (start,
    end, level) of every place where a disclosing term stands, with its entity or
    without, in order, never inside a pattern span; the highest of a term's levels holds.
    Null text is empty: no spans, the digest of the empty string.  Repeated
    rows are scanned row by row (as evidence they count once), an
    empty table gives an empty result, other columns are not read.
    """
    flagged = saved(disclosing(scan(docs, id_col, text_col), docs, text_col, **kw).groupBy("t").agg(F.max("level").alias("level")), "pii-flagged")
    found = saved(spotted(docs, slots(flagged), id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-spotted")
    hits = (matching(found.where(F.size("seen") > 0).select("row", F.inline("seen")), flagged, "t", "inner", SMALL)
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", "x", "level"))).alias("terms")))
    out = found.drop("seen").join(saved(hits, "pii-hits"), "row", "left").drop("row")
    return out.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<s:int,x:int,level:int>>")))


def span_rows(found: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and ``spans``: pattern spans, then ``term:start:end``."""
    terms = F.concat_ws(",", F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["s"].cast("string"), x["x"].cast("string"))))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
                        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(terms != "", terms)).alias("spans"),
                        F.size("terms").cast("bigint").alias("n_terms"))


def redacted(text: str | None, terms: list) -> str | None:
    """The text with its entities replaced by their kind, disclosing terms generalised or removed."""
    marks = [(s, e, f"[{k.upper()}]") for k, s, e in base_spans(text)]
    marks += [(x["s"], x["x"], "" if x["level"] == 2 else "[NUMBER]" if text[x["s"]:x["x"]].isdigit() else "[WORD]") for x in terms or []]
    if not marks:
        return text
    out, at = [], 0
    for s, e, mark in sorted(marks, key=lambda m: (m[0], -m[1])):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with personal data taken out of ``text_col``; rows and the other columns stay as they are.

    Only the rows that hold disclosing terms are looked up, by id and hash of the text.
    """
    i, h, x = fresh(docs, "cm_id", "cm_hash", "cm_terms")
    terms = (private_spans(docs, id_col, text_col, **kw).where(F.size("terms") > 0)
             .select(F.col("doc_id").alias(i), F.col("text_hash").alias(h), F.col("terms").alias(x)).dropDuplicates([i, h]))
    terms = saved(terms, "pii-terms")
    small = terms.limit(SMALL + 1).count() <= SMALL
    keyed = docs.join(F.broadcast(terms) if small else terms,
                      docs[id_col].eqNullSafe(terms[i]) & (F.xxhash64(docs[text_col]) == terms[h]), "left").drop(i, h)
    at, schema, names = docs.columns.index(text_col), docs.schema, docs.columns
    text_type = arrow_type(schema[text_col].dataType)

    def run(batches):
        for b in pieces(batches, text_col):
            texts = [redacted(t, x) for t, x in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist())]
            cols = [pa.array(texts, text_type) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return keyed.mapInArrow(run, schema)
