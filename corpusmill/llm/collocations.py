"""Phrase collocations by best-first branch and bound.

A phrase of m words grows from its prefix.  Cut after its first word, a phrase
scores at most ``scale * n / f(first word)``: the rest occurs at least as
often as the phrase.  That bound holds for everything that grows from a
prefix, so the frontier is the first words, the rarest (highest bound) first.
It is expanded in batches: the phrases that begin with a batch's words are counted
level by level, only those whose prefix is frequent go on.  A language is
settled when its top-th surviving score is higher than the bound of the first
words that are left; the rest of its frontier is never expanded.

Words are 64-bit hashes of (language, word), checked to be without collision,
and phrases are their words' hashes in a row, so counts are exact.  Tasks
know which words, prefixes and parts matter from bit tables of a bounded
size; a false hit costs a row, never a result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import arrow_batches, pieces, saved
from corpusmill.session import prepare

MIN_COUNT, MAX_WORDS, TOP, SCALE = 100, 5, 2000, 1000
SHARES = (1 / 8, 1 / 2, 1.0)       # of a language's words that the frontier's batches take
MIN_SLOTS, MAX_SLOTS = 1 << 22, 1 << 26    # bits of a table
CACHE = 100_000                    # words a task remembers
SLICE = 2 << 20                    # bytes of text that are encoded at a time
BLOB = 2 << 20                     # bytes of hashes that are worked on at a time
CHUNK = 1 << 16                    # words of a row of hashes, about
BATCH = 4 << 20                    # bytes that are handed to Python at a time
ROWS = 16 << 20                    # bytes of a row group of hashes
PIECE_END = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"                      # stands for the end of a piece; no byte of UTF-8 text
TO_ENDS = bytes.maketrans(PIECE_END, END * len(PIECE_END))
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """(hash, check) of one language's words; those that are not known yet are noted in ``new``."""

    def __init__(self, lang: str, seed: int):
        self.prefix, self.seed, self.new = lang.encode() + b"\0", seed, []
        self[END] = 0, 0

    def __missing__(self, word: bytes) -> tuple[int, int]:
        own = self.prefix + word
        h = self[word] = xxhash.xxh64_intdigest(own, self.seed) or 1, xxhash.xxh32_intdigest(own, self.seed)
        self.new.append(word)
        return h

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes in order, 0 after each piece (each text at least); and the distinct hashes with their counts and checks."""
        data = b"\n".join([*texts, b""]).lower().translate(TO_ENDS).replace(END, b" " + END + b" ")   # lower() of bytes: A-Z only
        words = pc.ascii_split_whitespace(pa.array([data], pa.binary()).view(pa.string())).flatten()
        coded = words.filter(pc.not_equal(pc.binary_length(words), 0)).dictionary_encode()
        known = [self[w] for w in coded.dictionary.view(pa.binary()).to_pylist()]
        hashes, checks = np.array([h for h, _ in known], np.uint64), np.array([x for _, x in known], np.int64)
        at = coded.indices.to_numpy()
        live = hashes != 0
        return hashes[at], hashes[live], np.bincount(at, minlength=len(hashes))[live], checks[live]


def encoded(docs: DataFrame, text_col: str, lang_col: str, seed: int) -> DataFrame:
    """A row per slice of texts and language: its word hashes, how often each distinct one is there, and the words the task had not met before."""
    prepare(docs.sparkSession)
    kinds = {"lang": pa.string(), "n": pa.int64(), "blob": pa.binary(), "hs": pa.list_(pa.int64()), "cs": pa.list_(pa.int32()), "xs": pa.list_(pa.int32()),
             "words": pa.binary()}

    def run(batches):
        known: dict = {}
        for b in pieces(batches, "text", SLICE):
            if sum(map(len, known.values())) > CACHE:
                known.clear()
            texts: dict = {}
            for t, lang in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()):
                if t:
                    texts.setdefault("und" if lang is None else lang, []).append(t)
            for lang, own in texts.items():
                if lang not in known:
                    known[lang] = Words(lang, seed)
                words = known[lang]
                h, value, count, check = words.encode(own)
                new = zstandard.compress(b"\n".join(words.new), 1)       # no word holds a line end
                words.new = []
                ends = np.flatnonzero(h == 0) + 1      # rows are cut where a piece ends
                cuts = np.unique(ends[np.searchsorted(ends, np.arange(CHUNK, len(h) + CHUNK, CHUNK)).clip(max=len(ends) - 1)])
                blobs = [x.tobytes() for x in np.split(h, cuts[:-1])]
                rest = [None] * (len(blobs) - 1)
                cols = [[lang] * len(blobs), [int(count.sum())] + [0] * len(rest), blobs, [value.view(np.int64), *rest],
                        [count.astype(np.int32), *rest], [check.astype(np.uint32).view(np.int32), *rest], [new, *rest]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds.values())], names=list(kinds))
    return docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).mapInArrow(
        run, "lang string, n bigint, blob binary, hs array<bigint>, cs array<int>, xs array<int>, words binary")


def names_of(enc: DataFrame, wanted: "Bits", seed: int) -> DataFrame:
    """(h, lang, w), each once: the noted words whose hashes ``wanted`` has, and some others."""
    def run(batches):
        met: set = set()                 # a task meets a frequent word in most of its slices
        for b in batches:
            for lang, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = [w for w in zstandard.decompress(packed).split(b"\n") if w]
                own = lang.encode() + b"\0"
                h = np.array([xxhash.xxh64_intdigest(own + w, seed) or 1 for w in words], np.uint64)
                at = [i for i in np.flatnonzero(wanted(mixed(h))) if h[i] not in met] if len(h) else []
                met = met if len(met) < CACHE else set()
                met.update(h[at])
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array([lang] * len(at), pa.string()),
                                                  pa.array([words[i] for i in at], pa.binary())], names=["h", "lang", "w"])
    return enc.where("words is not null").select("lang", "words").mapInArrow(run, "h bigint, lang string, w binary").distinct()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def rolled(w: np.ndarray, m: int) -> np.ndarray:
    """One number for every m words in a row (where they end before the array does), as table slots are taken of."""
    n = len(w) - m + 1
    h = mixed(w[:n])
    for k in range(1, m):
        h = mixed(h + w[k:k + n])
    return h


class Bits:
    """A table of bits of which the keys of a DataFrame set one each."""

    def __init__(self, keys: DataFrame, m: int):
        """``keys(key binary)``: the hashes of m words.  At most MAX_SLOTS bits come to the driver."""
        n = keys.count()
        self.m, self.any = m, n > 0
        size = max(MIN_SLOTS, min(MAX_SLOTS, 1 << (64 * n).bit_length()))
        self.mask = np.uint64(size - 1)

        def run(batches):
            for b in batches:
                if b.num_rows:
                    w = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64).reshape(-1, m)
                    at = np.unique(rows_mixed(w) & np.uint64(size - 1))
                    word, start = np.unique(at >> np.uint64(6), return_index=True)
                    value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start)
                    yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], names=["i", "v"])
        table = np.zeros(size // 64, np.uint64)
        if n:
            found = keys.mapInArrow(run, "i bigint, v bigint").groupBy("i").agg(F.bit_or("v").alias("v")).toArrow()
            table[found["i"].to_numpy()] = found["v"].to_numpy().view(np.uint64)
        self.table = table

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def rows_mixed(w: np.ndarray) -> np.ndarray:
    """``rolled`` of each row of a matrix."""
    h = mixed(w[:, 0])
    for k in range(1, w.shape[1]):
        h = mixed(h + w[:, k])
    return h


def blocks(batches):
    """The hashes of a column of blobs, BLOB bytes or one text at a time."""
    for b in pieces(batches, "blob", BLOB):
        w = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)
        if len(w):
            yield w


def grouped(w: np.ndarray, at: np.ndarray, m: int, before: bool) -> pa.RecordBatch | None:
    """Phrases of m words at the places ``at``: key, count and (if asked) the least and greatest word before them, 0 at a piece's start."""
    if not len(at):
        return None
    cols = {f"w{k}": w[at + k].view(np.int64) for k in range(m)}
    sums = [([], "count_all")]
    if before:
        cols["left"] = np.where(at > 0, w[at - 1], 0).view(np.int64)
        sums += [("left", "min"), ("left", "max")]
    t = pa.table(cols).group_by([f"w{k}" for k in range(m)], use_threads=False).aggregate(sums)
    key = np.ascontiguousarray(np.stack([t[f"w{k}"].to_numpy() for k in range(m)], 1))
    keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * m), len(key), [None, pa.py_buffer(key)]).cast(pa.binary())
    names = ["key", "a", "left_min", "left_max"][:4 if before else 2]
    return pa.RecordBatch.from_arrays([keys, t["count_all"].combine_chunks(), *[t[c].combine_chunks() for c in names[2:]]], names=names)


def level(blobs: DataFrame, m: int, prefix: Bits, frequent: Bits, min_count: int) -> DataFrame:
    """(key, a): phrases of m words, min_count times or more, whose prefix is in ``prefix`` (false hits of its table included)."""
    def run(batches):
        for w in blocks(batches):
            if len(w) < m:
                continue
            n = len(w) - m + 1
            last = w[m - 1:]
            ok = prefix(rolled(w, m - 1)[:n])
            ok &= frequent(mixed(last))
            for k in range(m):
                ok &= w[k:k + n] != 0
            found = grouped(w, np.flatnonzero(ok), m, False)
            if found is not None:
                yield found
    return (blobs.mapInArrow(run, "key binary, a bigint").groupBy("key").agg(F.sum("a").alias("a"))
                 .where(F.col("a") >= min_count))


def counts_of(blobs: DataFrame, keys: DataFrame, lengths) -> DataFrame:
    """(key, f, left_min, left_max): how often each of ``keys(key)`` occurs, and the words before it (and some other keys)."""
    tables = [t for t in (Bits(keys.where(F.octet_length("key") == 8 * m), m) for m in lengths) if t.any]

    def run(batches):
        for w in blocks(batches):
            for t in tables:
                m = t.m
                n = len(w) - m + 1
                if n < 1:
                    continue
                ok = t(rolled(w, m))
                for k in range(m):
                    ok &= w[k:k + n] != 0
                found = grouped(w, np.flatnonzero(ok), m, True)
                if found is not None:
                    yield found
    return (blobs.mapInArrow(run, "key binary, a bigint, left_min bigint, left_max bigint").groupBy("key")
                 .agg(F.sum("a").alias("f"), F.min("left_min").alias("left_min"), F.max("left_max").alias("left_max")))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, shares=SHARES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` best phrases.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends
    and into words at spaces and tabs.  Of a phrase of 2 to ``max_words`` words that
    occurs a >= ``min_count`` times inside pieces, the cut with the lowest
    floor(SCALE * a * n / (l * r)) counts, ties to the shortest first part.  A phrase is left out if
    a longer phrase within ``max_words`` holds it wherever it occurs: if all its places have the same word
    before them, or all the same word behind.  Rank goes by score, then a, then the phrase in byte order.

    Null text has no words; null lang is ``und``, together with a lang of that name.
    Repeated rows count as often as they stand there, an empty table gives an empty
    result, other columns are not read.
    """
    with arrow_batches(docs.sparkSession, BATCH):
        return _collocations(docs, text_col, lang_col, min_count, max_words, top, shares)


def _collocations(docs: DataFrame, text_col: str, lang_col: str, min_count: int, max_words: int, top: int, shares) -> DataFrame:
    for seed in itertools.count(42):
        enc = saved(encoded(docs, text_col, lang_col, seed), "colloc-encoded", compression="none", **{"parquet.block.size": str(ROWS)})
        code = F.xxhash64(F.lit(seed), "lang").alias("code")
        sums = enc.select(code, F.inline(F.arrays_zip("hs", "cs", "xs"))).groupBy(F.col("hs").alias("h")).agg(
            F.sum("cs").alias("f"), F.max("code").alias("code"), (F.min("xs") != F.max("xs")).alias("two"))
        counts = saved(sums.where((F.col("f") >= min_count) | F.col("two")), "colloc-counts")
        totals = saved(enc.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0").select("lang", "n", code), "colloc-totals")
        if counts.where("two").limit(1).count() == 0 and totals.groupBy("code").count().where("count > 1").limit(1).count() == 0:
            break                                   # no two words, no two languages share a hash
    blobs = enc.select("blob")
    words = saved(counts.select("h", "f", "code").join(totals.select("code", "lang"), "code").select("lang", "h", "f"), "colloc-words")
    # Batches of the frontier: first words by the power of two of their count, so a language has at most 63 bins.
    binned = words.withColumn("bin", F.floor(F.log2("f")).cast("int"))
    share = binned.groupBy("lang", "bin").agg(F.sum("f").alias("occ"))
    upto = F.sum("occ").over(Window.partitionBy("lang").orderBy("bin")) / F.sum("occ").over(Window.partitionBy("lang"))
    wave = F.lit(len(shares) - 1)
    for i in reversed(range(len(shares) - 1)):
        wave = F.when(F.col("upto") <= shares[i], F.lit(i)).otherwise(wave)
    share = share.withColumn("upto", upto).withColumn("wave", wave)
    words = saved(binned.join(share.select("lang", "bin", "wave"), ["lang", "bin"]).join(totals, "lang")
                        .select("lang", "h", "f", "n", "wave", _key_of("h").alias("key")), "colloc-frequent")
    least = saved(words.groupBy("lang", "wave").agg(F.min("f").alias("f"), F.max("n").alias("n")), "colloc-bounds")
    frequent = Bits(words.select("key"), 1)
    scored = None
    open_langs = totals.select("lang")
    for now in range(len(shares)):
        first = words.where(F.col("wave") == now).join(open_langs, "lang", "left_semi")
        found = _expand(blobs, words, first.select("key"), frequent, min_count, max_words)
        if found is not None:
            found = found.withColumn("w0", F.substring("key", F.lit(1), F.lit(8))).join(
                words.select(F.col("key").alias("w0"), "lang"), "w0").drop("w0")
            scored = found if scored is None else scored.unionByName(found)
            scored = saved(scored, "colloc-scored")
        if now == len(shares) - 1:
            break
        bound = least.where(F.col("wave") > now).groupBy("lang").agg(F.max(_score(F.lit(1), F.col("n"), F.col("f"), F.lit(1))).alias("bound"))
        if scored is None:
            continue
        last = _best(scored, top).groupBy("lang").agg(F.count(F.lit(1)).alias("k"), F.min("score").alias("score"))
        settled = last.join(bound, "lang", "left").where((F.col("k") >= top) & (F.col("bound").isNull() | (F.col("score") > F.col("bound"))))
        open_langs = saved(totals.select("lang").join(settled.select("lang"), "lang", "left_anti"), "colloc-open")
        if open_langs.join(least.where(F.col("wave") > now), "lang", "left_semi").limit(1).count() == 0:
            break
    if scored is None:
        return totals.where("1 = 0").select("lang", F.lit(0).alias("rank"), F.lit("").alias("phrase"), F.col("n").alias("a"),
                                            F.col("n").alias("l"), F.col("n").alias("r"), "n", F.col("n").alias("score"))
    # All that tie with the last place get their words back, then the final order cuts.
    edge = _best(scored, top).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("edge"))
    cand = saved(scored.join(edge, "lang").where(F.struct("score", "a") >= F.col("edge"))
                       .select("lang", "key", "a", "l", "r", "score"), "colloc-candidates")
    at = F.posexplode(F.transform(F.sequence(F.lit(0), (F.octet_length("key") / 8 - 1).cast("int")),
                                  lambda i: F.substring("key", i * 8 + 1, F.lit(8)))).alias("i", "k")
    parts = cand.select("lang", "key", "a", "l", "r", "score", at)
    # Words that are in no phrase of the result stay hashes.
    names = names_of(enc, Bits(parts.select(F.col("k").alias("key")).distinct(), 1), seed)
    named = (parts.join(names.select(_key_of("h").alias("k"), F.col("w").cast("string").alias("w")), "k")
                 .join(totals.select("lang", "n"), "lang")
                 .groupBy("lang", "key", "a", "l", "r", "score", "n")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
                 .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _key_of(h: str) -> Column:
    """The 8 bytes of a hash, lowest first, as tasks write them."""
    x = F.lpad(F.hex(F.col(h)), 16, "0")
    return F.unhex(F.concat(*[F.substring(x, 15 - 2 * i, 2) for i in range(8)]))


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(SCALE * a * n / (l * r)), in decimals of 38 digits."""
    a, n, l, r = (x.cast("decimal(19,0)") for x in (a, n, l, r))  # noqa: E741
    return F.call_function("div", (a * n).cast("decimal(34,0)") * F.lit(SCALE).cast("decimal(4,0)"), l * r)


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def _expand(blobs: DataFrame, words: DataFrame, first: DataFrame, frequent: Bits, min_count: int, max_words: int) -> DataFrame | None:
    """(key, a, l, r, n, score) of the surviving phrases that begin with the words ``first(key)``."""
    prefix = Bits(first, 1)
    found: list = []                                # levels, from two words up
    while prefix.any and len(found) + 2 <= max_words:
        m = len(found) + 2
        counted = saved(level(blobs, m, prefix, frequent, min_count), f"colloc-counted{m}")
        # False hits of the bit tables go: the prefix has to be there.
        head = first if m == 2 else found[-1].select("key")
        counted = counted.withColumn("head", F.substring("key", F.lit(1), F.lit(8 * (m - 1)))).join(
            head.select(F.col("key").alias("head")), "head", "left_semi").drop("head")
        found.append(saved(counted, f"colloc-level{m}"))
        prefix = Bits(found[-1].select("key"), m)
    if not found:
        return None
    every = found[0].select("key", "a")
    for x in found[1:]:
        every = every.unionByName(x.select("key", "a"))
    # Longer phrases with the same word behind are in the next level; the words before are counted below.
    alive = None
    for m, x in enumerate(found, 2):
        live = x.select("key", "a", F.lit(m).alias("m"))
        if m - 1 < len(found):
            longer = found[m - 1].groupBy(F.substring("key", F.lit(1), F.lit(8 * m)).alias("key")).agg(F.max("a").alias("b"))
            live = live.join(longer, "key", "left").where("b is null or b < a").drop("b")
        alive = live if alive is None else alive.unionByName(live)
    alive = saved(alive, "colloc-alive")
    k = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    cuts = alive.select("key", "a", "m", k).select(
        "key", "a", "k", F.substring("key", F.lit(1), F.col("k") * 8).alias("head"),
        F.substring("key", F.col("k") * 8 + 1, (F.col("m") - F.col("k")) * 8).alias("tail"))
    asked = cuts.where(F.octet_length("tail") > 8).select(F.col("tail").alias("key"))
    asked = saved(asked.unionByName(alive.where(F.col("m") < max_words).select("key")).distinct(), "colloc-asked")
    told = saved(counts_of(blobs, asked, range(2, max_words)), "colloc-told").join(asked, "key", "left_semi")
    covered = told.where((F.col("left_min") == F.col("left_max")) & (F.col("left_min") != 0)).select("key")
    longest = F.octet_length("key") == 8 * max_words
    alive = alive.where(longest).unionByName(alive.where(~longest).join(covered, "key", "left_anti"))
    cuts = cuts.join(alive.select("key"), "key", "left_semi")
    tail_counts = told.select("key", "f").unionByName(words.select("key", "f"))
    head_counts = every.unionByName(words.select("key", F.col("f").alias("a")))
    # n is the language's, which the first word tells.
    lang_n = words.select(F.col("key").alias("w0"), "n")
    joined = (cuts.join(head_counts.select(F.col("key").alias("head"), F.col("a").alias("l")), "head")
                  .join(tail_counts.select(F.col("key").alias("tail"), F.col("f").alias("r")), "tail")
                  .withColumn("w0", F.substring("key", F.lit(1), F.lit(8))).join(lang_n, "w0")
                  .withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))))
    return (joined.groupBy("key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
                  .select("key", "a", "x.l", "x.r", "x.score"))
