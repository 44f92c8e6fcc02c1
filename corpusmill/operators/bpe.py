"""Byte-level BPE on Spark: pre-token counting, batched exact merge training, encode/decode.

Training works on the table of *distinct* pre-tokens, never
on documents: the corpus is read once (D1).  Words are kept in blocks, flat
symbol arrays that tasks work on as a whole, and the table of pair counts is
kept up to date by the changes that a round's touched words make.  In a round the
top K pairs (a parameter) come to the driver, and the distinct segments of words
that are made of these pairs alone (``MAX_SEGMENTS`` bytes at most: fewer pairs are
taken where they would be more).  From them the driver takes as many
merges as are certain (``plan_merges``), and the tasks apply the batch to
their blocks.

Why the batch equals one merge at a time: all places of the top K pairs are in the
segments, so their counts, and those of all pairs that merges make inside, are known
exactly.  Any other pair comes from a place whose pair ranks after the K-th
at the round's start, and it ranks after it too: its count is no higher,
and on equal counts the newer symbol ranks last.  So the batch ends where the
K-th pair of the start would be passed.  Checked against a
sequential reference in tests/test_bpe.py.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import defaultdict
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.encode import encode_columns
from corpusmill.operators.joins import materialize

BYTE_OFFSET = len(tx.SPECIAL_TOKENS)          # byte b has id BYTE_OFFSET + b
FIRST_MERGE_ID = BYTE_OFFSET + 256
VOCAB_SIZE = 25000
TOP_K = 4096
FIRST_WIDTH = 64             # of the top pairs, those whose segments the first round takes
MAX_SEGMENTS = 2 << 20       # bytes of segments (4 a symbol) that come to the driver in a round
TASK_WORDS = 100_000         # distinct pre-tokens that a task of a training round takes, where there are more tasks than cores


def pretokens(text) -> "F.Column":
    return F.regexp_extract_all(tx.col_(text), F.lit(tx.PRETOKEN_RE), 0)


def pretoken_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) for every distinct pre-token (map-side partial counts, then one shuffle)."""
    return (df.select(F.explode(pretokens(text_col)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def byte_ids(word) -> "F.Column":
    """UTF-8 bytes of a string as base-alphabet ids (JVM only: hex digits -> ints)."""
    h = F.hex(F.encode(tx.col_(word), "UTF-8"))
    nb = (F.length(h) / 2).cast("int")
    return F.when(nb > 0, F.transform(F.sequence(F.lit(0), nb - 1),
                                      lambda i: (F.conv(F.substring(h, i * 2 + 1, 2), 16, 10).cast("int")
                                                 + F.lit(BYTE_OFFSET)))).otherwise(F.array().cast("array<int>"))


# Symbols are carried as one BMP character per token id while training, so that a
# merge is a plain left-to-right, non-overlapping String.replace and pair counting
# is one regex scan - JVM string kernels instead of interpreted array lambdas.
# Code points start at SYM_BASE and skip the surrogate block; the UTF-8 byte order
# of such strings equals the order of the ids they carry.
SYM_BASE = 0x800
MAX_VOCAB = 0xFFFF - 0x800 - SYM_BASE + 1


def sym_char(i: int) -> str:
    cp = SYM_BASE + i
    return chr(cp if cp < 0xD800 else cp + 0x800)


def char_sym(c: str) -> int:
    cp = ord(c)
    return (cp if cp < 0xD800 else cp - 0x800) - SYM_BASE


def _sym_id_col(c) -> "F.Column":
    cp = F.ascii(c)
    return (F.when(cp < 0xD800, cp).otherwise(cp - 0x800) - SYM_BASE).cast("int")


_LATIN1 = "".join(chr(b) for b in range(256))
_BYTE_SYMS = "".join(sym_char(BYTE_OFFSET + b) for b in range(256))
_PAIRS_RE = "(?s)(?=(..))"


def sym_string(word) -> "F.Column":
    """A pre-token as its base-alphabet symbol string (bytes via Latin-1, then one translate)."""
    return F.translate(F.decode(F.encode(tx.col_(word), "UTF-8"), "ISO-8859-1"), _LATIN1, _BYTE_SYMS)


def special_tokens(spark: SparkSession) -> DataFrame:
    """<pad>=0, <unk>=1, <eos>=2."""
    rows = [(i, t.encode("utf-8"), "special") for t, i in tx.SPECIAL_TOKENS]
    return spark.createDataFrame(rows, "token_id int, token binary, kind string")


def base_alphabet(spark: SparkSession) -> DataFrame:
    """One id per byte value, after the special tokens."""
    return spark.range(256).select((F.col("id") + BYTE_OFFSET).cast("int").alias("token_id"),
                                   F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"),
                                   F.lit("byte").alias("kind"))


def word_symbols(counts: DataFrame) -> DataFrame:
    """(word, n, syms): distinct pre-tokens as base-alphabet symbol strings."""
    return counts.select("word", "n", sym_string("word").alias("syms"))


def symbol_ids(syms) -> "F.Column":
    """A symbol string as an id array (for inspection and tests)."""
    s = tx.col_(syms)
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: _sym_id_col(F.substring(s, i, 1)))


def _pair_strings(words: DataFrame, syms_col: str = "syms") -> DataFrame:
    return (words.where(F.length(syms_col) >= 2)
                 .select("n", F.explode(F.regexp_extract_all(F.col(syms_col), F.lit(_PAIRS_RE), 1)).alias("p"))
                 .groupBy("p").agg(F.sum("n").cast("bigint").alias("n")))


def pair_counts(words: DataFrame, syms_col: str = "syms") -> DataFrame:
    """D3: (left_id, right_id, n) = sum of word frequency over adjacent symbol pairs."""
    return _pair_strings(words, syms_col).select(_sym_id_col(F.substring("p", 1, 1)).alias("left_id"),
                                                 _sym_id_col(F.substring("p", 2, 1)).alias("right_id"), "n")


def select_merges(ranked, next_id: int) -> list[tuple[int, int, int]]:
    """The longest symbol-disjoint prefix of ranked (left, right, n) rows -> (left, right, new_id)."""
    used: set[int] = set()
    out = []
    for row in ranked:
        l, r = int(row[0]), int(row[1])
        if l in used or r in used:
            break
        out.append((l, r, next_id + len(out)))
        if l == r:
            break
        used.update((l, r))
    return out


def apply_merges_expr(syms, batch: list[tuple[int, int, int]]) -> "F.Column":
    """Left-to-right, non-overlapping replacement of a symbol-disjoint merge batch.

    Pairs of one batch share no symbol and new ids are fresh, so replacing them
    one after another equals replacing them simultaneously.
    """
    out = tx.col_(syms)
    for l, r, new in batch:
        out = F.replace(out, F.lit(sym_char(l) + sym_char(r)), F.lit(sym_char(new)))
    return out


def apply_merges(words: DataFrame, batch: list[tuple[int, int, int]], syms_col: str = "syms") -> DataFrame:
    return words.withColumn(syms_col, apply_merges_expr(syms_col, batch))


def plan_merges(top, segments, truncated: bool, next_id: int, limit: int, min_count: int = 1) -> list[tuple[int, int, int]]:
    """The merges that one-at-a-time BPE takes next, as far as ``top`` decides it.

    ``top``: (left, right, n) in rank order (n descending, left, right);
    ``segments``: (symbols, n), the longest parts of words whose pairs are all in ``top``;
    ``truncated``: there may be pairs that rank after the last.
    """
    last = (-top[-1][2], top[-1][0], top[-1][1]) if truncated and top else None
    words, weight = [list(s) for s, _ in segments], [n for _, n in segments]
    count: dict = defaultdict(int)
    where, heap = defaultdict(set), []
    for i, w in enumerate(words):
        for p in zip(w, w[1:]):
            count[p] += weight[i]
            where[p].add(i)

    def put(p):
        key = (-count[p], *p)
        # Counts of pairs that are there only fall: what ranks too low now never rises.
        if -key[0] >= min_count and (last is None or key <= last):
            heapq.heappush(heap, key)
    for p in count:
        put(p)
    out: list[tuple[int, int, int]] = []
    while heap and len(out) < limit:
        n, l, r = heapq.heappop(heap)
        if count[l, r] != -n:                  # an older count of this pair
            continue
        z = next_id + len(out)
        out.append((l, r, z))
        change: dict = defaultdict(int)
        for i in where.pop((l, r)):
            old, new, k = words[i], [], 0
            while k < len(old):
                if old[k] == l and k + 1 < len(old) and old[k + 1] == r:
                    new.append(z)
                    k += 2
                else:
                    new.append(old[k])
                    k += 1
            if len(new) == len(old):           # other merges took the pair's places here
                continue
            words[i] = new
            for p in zip(old, old[1:]):
                change[p] -= weight[i]
            for p in zip(new, new[1:]):
                change[p] += weight[i]
                if z in p:
                    where[p].add(i)
        for p, d in change.items():
            if d:
                count[p] += d
                put(p)
    return out


def merge_symbols(syms: list, ranks: dict) -> list:
    """Apply merges to one word, lowest rank first, left to right; n log n for a word of n symbols.

    ``ranks``: {(left, right): (rank, new)}.  A list of neighbours and a heap of
    the pairs that can be merged; a merge made of merges ranks after them.
    """
    n = len(syms)
    if n < 2:
        return syms
    syms, right, left = list(syms), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*ranks[p], i) for i, p in enumerate(zip(syms, syms[1:])) if p in ranks]
    if not heap:
        return syms
    heapq.heapify(heap)
    while heap:
        rank, new, i = heapq.heappop(heap)
        j = right[i]
        if syms[i] is None or j >= n or ranks.get((syms[i], syms[j])) != (rank, new):
            continue
        syms[i], syms[j] = new, None
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (m := ranks.get((new, syms[k]))):
                heapq.heappush(heap, (*m, i))
        h = left[i]
        if h >= 0 and (m := ranks.get((syms[h], new))):
            heapq.heappush(heap, (*m, h))
    return [s for s in syms if s is not None]


# --- D6: word blocks and counts kept up to date ------------------------------

BLOCK_SCHEMA = "syms binary, weights binary, pairs array<bigint>, changes array<bigint>"


def _pair_sums(syms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adjacent pairs, as left * 2**32 + right, with their words' weights added up.  ``weights``: one per position."""
    ok = (syms[:-1] >= 0) & (syms[1:] >= 0)
    code = (syms[:-1][ok].astype(np.int64) << 32) | syms[1:][ok]
    pairs, at = np.unique(code, return_inverse=True)
    sums = np.zeros(len(pairs), np.int64)
    np.add.at(sums, at, weights[:-1][ok])
    return pairs, sums


def _merge_block(syms: np.ndarray, weights: np.ndarray, codes: np.ndarray, ranks: np.ndarray, news: np.ndarray):
    """A block after a batch of merges, in every word the earliest merge first.

    ``syms``: the symbols of all words, -1 after each; ``codes`` are the sorted
    pairs of the batch.  Each step makes every word's earliest merge at all its places, from the left.
    """
    done_s, done_w = [], []
    while len(syms):
        at = np.minimum(np.searchsorted(codes, code := (syms[:-1].astype(np.int64) << 32) | np.maximum(syms[1:], 0)), len(codes) - 1)
        hit = (codes[at] == code) & (syms[:-1] >= 0) & (syms[1:] >= 0)
        rank = np.append(np.where(hit, ranks[at], len(ranks)), len(ranks))
        ends = np.flatnonzero(syms < 0)
        starts = np.concatenate([[0], ends[:-1] + 1])
        sizes = ends - starts + 1
        least = np.minimum.reduceat(rank, starts)
        live = np.repeat(least < len(ranks), sizes)
        done_s.append(syms[~live])
        done_w.append(weights[~live])
        place = (rank == np.repeat(least, sizes))[live]
        syms, weights, rank = syms[live], weights[live], rank[live]
        if not len(syms):
            break
        i = np.flatnonzero(place)
        # A run of places one after another is a run of one symbol: every second one counts.
        fresh = np.concatenate([[True], i[1:] != i[:-1] + 1])
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(i)), 0))
        i = i[(np.arange(len(i)) - run) % 2 == 0]
        by_rank = np.empty(len(ranks), np.int64)
        by_rank[ranks] = news
        syms[i] = by_rank[rank[i]]
        keep = np.ones(len(syms), bool)
        keep[i + 1] = False
        syms, weights = syms[keep], weights[keep]
    return np.concatenate(done_s or [syms]), np.concatenate(done_w or [weights])


def _words_of(syms: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """``mask`` spread to all positions of the words that hold a marked one."""
    ends = np.flatnonzero(syms < 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.repeat(np.logical_or.reduceat(mask, starts), ends - starts + 1) if len(ends) else mask


def _block_row(syms, weights, pairs, changes) -> pa.RecordBatch:
    lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (pairs, changes)]
    return pa.RecordBatch.from_arrays([pa.array([syms.astype(np.int32).tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary()), *lists],
                                      names=["syms", "weights", "pairs", "changes"])


def word_blocks(counts: DataFrame) -> DataFrame:
    """Blocks of distinct pre-tokens (``BLOCK_SCHEMA``): flat symbol arrays with their pair counts as the first changes."""
    def run(batches):
        for b in batches:
            parts, weight = [], []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = w.encode("utf-8")
                if len(raw) > 1:                  # a word of one symbol never forms a pair
                    parts.append(raw)
                    weight.append(n)
            if not parts:
                continue
            sizes = np.array([len(x) + 1 for x in parts])
            syms = np.full(sizes.sum(), -1, np.int64)
            inside = np.ones(len(syms), bool)
            inside[np.cumsum(sizes) - 1] = False
            syms[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + BYTE_OFFSET
            weights = np.repeat(np.array(weight, np.int64), sizes)
            yield _block_row(syms, weights, *_pair_sums(syms, weights))
    return counts.select("word", "n").mapInArrow(run, BLOCK_SCHEMA)


def _blocks(batches):
    for b in batches:
        for s, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if s:                                 # all words of a block may have left
                yield np.frombuffer(s, np.int32).astype(np.int64), np.frombuffer(w, np.int64)


def merged_blocks(blocks: DataFrame, batch: list[tuple[int, int, int]]) -> DataFrame:
    """D5 over blocks: the batch applied, and what it changes in the pair counts, from the touched words alone.

    Words that come down to one symbol leave.
    """
    code = np.array([(l << 32) | r for l, r, _ in batch], np.int64)
    order = np.argsort(code)
    codes, ranks, news = code[order], order.astype(np.int64), np.array([batch[i][2] for i in order], np.int64)

    def run(batches):
        for syms, weights in _blocks(batches):
            pairs = (syms[:-1] << 32) | np.maximum(syms[1:], 0)
            at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
            hit = np.append((codes[at] == pairs) & (syms[:-1] >= 0) & (syms[1:] >= 0), False)
            touched = _words_of(syms, hit)
            old_s, old_w = syms[touched], weights[touched]
            new_s, new_w = _merge_block(old_s, old_w, codes, ranks, news)
            a, x = _pair_sums(old_s, old_w) if len(old_s) else (np.empty(0, np.int64),) * 2
            c, y = _pair_sums(new_s, new_w) if len(new_s) else (np.empty(0, np.int64),) * 2
            keys, at = np.unique(np.concatenate([a, c]), return_inverse=True)
            change = np.zeros(len(keys), np.int64)
            np.add.at(change, at, np.concatenate([-x, y]))
            moved = change != 0
            # Of what is left of a touched word, one symbol and its end are no pair any more.
            ends = np.flatnonzero(new_s < 0)
            sizes = np.diff(np.concatenate([[-1], ends]))
            stay = np.repeat(sizes > 2, sizes) if len(ends) else np.empty(0, bool)
            yield _block_row(np.concatenate([syms[~touched], new_s[stay]]), np.concatenate([weights[~touched], new_w[stay]]),
                             keys[moved], change[moved])
    return blocks.select("syms", "weights").mapInArrow(run, BLOCK_SCHEMA)


def changes_of(blocks: DataFrame) -> DataFrame:
    """(p, n): the changes of the pair counts that came with these blocks, added up."""
    return (blocks.select(F.inline(F.arrays_zip("pairs", "changes"))).groupBy(F.col("pairs").alias("p"))
                  .agg(F.sum("changes").alias("n")))


def segment_counts(blocks: DataFrame, top: list[tuple[int, int]]) -> DataFrame:
    """(seg, n): the longest parts of words whose pairs are all in ``top``, as 32-bit symbols, with their words' weights added up."""
    codes = np.sort(np.array([(l << 32) | r for l, r in top], np.int64))

    def run(batches):
        for syms, weights in _blocks(batches):
            pairs = (syms[:-1] << 32) | np.maximum(syms[1:], 0)
            at = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
            hit = np.concatenate([[False], (codes[at] == pairs) & (syms[:-1] >= 0) & (syms[1:] >= 0), [False]])
            first = np.flatnonzero(hit[1:] & ~hit[:-1])
            if not len(first):
                continue
            inside = hit[1:] | hit[:-1]           # either symbol of a pair
            ends = np.flatnonzero(hit[:-1] & ~hit[1:]) + 1
            offsets = np.concatenate([[0], np.cumsum((ends - first) * 4)]).astype(np.int32)
            data = np.ascontiguousarray(syms[inside].astype(np.int32))
            segs = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            t = pa.table({"seg": segs, "n": pa.array(weights[first])}).group_by("seg", use_threads=False).aggregate([("n", "sum")])
            yield pa.RecordBatch.from_arrays([t["seg"].combine_chunks(), t["n_sum"].combine_chunks()], names=["seg", "n"])
    return (blocks.select("syms", "weights").mapInArrow(run, "seg binary, n bigint")
                  .groupBy("seg").agg(F.sum("n").cast("bigint").alias("n")))


def _segments(blocks: DataFrame, top: list, width: int) -> tuple[list, int, int]:
    """Segments of the first ``width`` pairs of ``top``, or of as many (halved) as keep within ``MAX_SEGMENTS``; that number; and their bytes."""
    while True:
        segs = segment_counts(blocks, [(l, r) for l, r, _ in top[:width]]).persist()
        size = segs.agg(F.sum(F.octet_length("seg")).alias("b")).first()["b"]
        if size <= MAX_SEGMENTS or width == 1:
            break
        segs.unpersist()
        width = max(1, min(width, len(top)) // 2)
    rows = segs.toArrow()
    segs.unpersist()
    found = [np.frombuffer(x, np.int32).tolist() for x in rows["seg"].to_pylist()]
    return list(zip(found, rows["n"].to_pylist())), width, size


@contextmanager
def shuffles(spark: SparkSession, parts: int):
    """What is planned inside shuffles into ``parts`` partitions."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(parts))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def train_bpe(df: DataFrame, vocab_size: int = VOCAB_SIZE, min_count: int = 2, top_k: int = TOP_K,
              text_col: str = "text", checkpoint_every: int = 8, counts: DataFrame | None = None):
    """Byte-level BPE merges until ``vocab_size`` ids or no pair with count >= min_count.

    Returns (vocab, merges) DataFrames; both are bounded by ``vocab_size``.
    What comes to the driver is bounded by ``top_k`` pairs and ``MAX_SEGMENTS`` bytes of segments.

    The table of pair counts is kept between rounds and only brought up to
    date: a batch of merges changes the counts by what its touched words
    contribute before and after.  A pair below ``min_count`` leaves the table for good,
    as counts only fall after the round that makes a pair's newer symbol.

    A round's tasks are as many as the words need, at least one a core: there are many rounds of a
    few stages each, and a task that adds up a few thousand pairs costs a multiple of its rows.
    """
    spark = df.sparkSession
    counts = (counts if counts is not None else pretoken_counts(df, text_col)).persist()
    try:
        parts = max(spark.sparkContext.defaultParallelism, -(-counts.count() // TASK_WORDS))
        with shuffles(spark, parts):
            merges = _merges(counts.repartition(parts), vocab_size, min_count, top_k, checkpoint_every)
    finally:
        counts.unpersist()
    return vocab_table(spark, merges), merges_table(spark, merges)


def _merges(counts: DataFrame, vocab_size: int, min_count: int, top_k: int, checkpoint_every: int) -> list[tuple[int, int, int]]:
    """The merges of ``train_bpe`` over distinct pre-tokens and their counts."""
    blocks = materialize(word_blocks(counts))
    pairs = materialize(changes_of(blocks).where(F.col("n") >= min_count))
    merges: list[tuple[int, int, int]] = []
    cached: list[DataFrame] = []
    rounds, width = 0, min(top_k, FIRST_WIDTH)
    while FIRST_MERGE_ID + len(merges) < vocab_size:
        top = [(r["p"] >> 32, r["p"] & 0xFFFFFFFF, r["n"])
               for r in pairs.orderBy(F.desc("n"), F.asc("p")).limit(top_k).collect()]
        while len(cached) > 2:
            cached.pop(0).unpersist()
        if not top:
            break
        segments, width, size = _segments(blocks, top, width)
        batch = plan_merges(top[:width], segments, len(top) > width or len(top) == top_k,
                            FIRST_MERGE_ID + len(merges), vocab_size - FIRST_MERGE_ID - len(merges), min_count)
        if size <= MAX_SEGMENTS // 4:
            width = min(top_k, 2 * width)
        merges.extend(batch)
        rounds += 1
        # Reliable checkpoints every few rounds keep plans flat; a lost executor
        # replays at most ``checkpoint_every`` rounds from the shared checkpoint dir.
        keep = materialize if rounds % checkpoint_every == 0 else (lambda x: x.persist())
        blocks = keep(merged_blocks(blocks, batch))
        change = changes_of(blocks).withColumnRenamed("n", "d")
        pairs = keep(pairs.join(change, "p", "full_outer")
                          .select("p", (F.coalesce("n", F.lit(0)) + F.coalesce("d", F.lit(0))).alias("n"))
                          .where(F.col("n") >= min_count))
        if rounds % checkpoint_every:
            cached += [blocks, pairs]
    for old in cached:
        old.unpersist()
    return merges


def merges_table(spark: SparkSession, merges) -> DataFrame:
    rows = [(rank, l, r, new) for rank, (l, r, new) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int")


def token_bytes(merges) -> dict[int, bytes]:
    """id -> bytes for specials, the byte alphabet and every merge (bounded by vocab_size)."""
    tb = {i: t.encode("utf-8") for t, i in tx.SPECIAL_TOKENS}
    tb.update({BYTE_OFFSET + b: bytes([b]) for b in range(256)})
    for l, r, new in merges:
        tb[new] = tb[l] + tb[r]
    return tb


def vocab_table(spark: SparkSession, merges) -> DataFrame:
    tb = token_bytes(merges)
    kinds = {i: "special" for _, i in tx.SPECIAL_TOKENS}
    rows = [(i, tb[i], kinds.get(i, "byte" if i < FIRST_MERGE_ID else "merge")) for i in sorted(tb)]
    return spark.createDataFrame(rows, "token_id int, token binary, kind string")


# --- E1: encode / decode -----------------------------------------------------

def _ranks(merges) -> dict:
    return {(l, r): (rank, new) for rank, (l, r, new) in enumerate(merges)}


def encode_word(word: str, ranks: dict) -> list[int]:
    return merge_symbols([BYTE_OFFSET + x for x in word.encode("utf-8")], ranks)


CACHED_WORDS = 200_000


def bpe_ids(merges):
    """``ids_of`` of the merges (bounded by the vocabulary), which go to the tasks; each remembers the words it has met."""
    if isinstance(merges, DataFrame):
        merges = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    ranks = _ranks(merges)

    def ids_of():
        words, seen = re.compile(tx.PRETOKEN_RE), {}

        def encode(text):
            ids = []
            for w in words.findall(text):
                x = seen.get(w)
                if x is None:
                    if len(seen) >= CACHED_WORDS:
                        seen.clear()
                    x = seen[w] = encode_word(w, ranks)
                ids += x
            return ids
        return encode
    return ids_of


def bpe_encode(df: DataFrame, merges, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, input_ids, n_tokens): documents are encoded where they are read, nothing is shuffled."""
    out = encode_columns(df.select(F.col(id_col), F.col(text_col)), bpe_ids(merges), {text_col: "input_ids"})
    return out.withColumn("n_tokens", F.size("input_ids").cast("bigint"))


def bpe_decode(encoded: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text): ids -> token bytes (vocab, bounded by vocab_size, sent to the tasks) -> UTF-8 text."""
    tokens = {r["token_id"]: bytes(r["token"]) for r in vocab.collect()}
    src = encoded.select(id_col, "input_ids")

    def run(batches):
        for b in batches:
            text = [b"".join(map(tokens.__getitem__, x or ())).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=[id_col, "text"])
    return src.mapInArrow(run, src.select(id_col, F.lit("").alias("text")).schema)


def vocab_report(encoded: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens, words, tokens per word and bytes per token, by language."""
    j = encoded.select(id_col, "n_tokens").join(
        docs.select(id_col, "lang", tx.word_count(text_col).alias("w"),
                    F.octet_length(text_col).cast("bigint").alias("b")), id_col)
    a = j.groupBy("lang").agg(F.sum("n_tokens").cast("bigint").alias("tokens"),
                              F.sum("w").cast("bigint").alias("words"), F.sum("b").cast("bigint").alias("bytes"))
    return a.select("lang", "tokens", "words", tx.safe_ratio("tokens", "words").alias("tokens_per_word"),
                    tx.safe_ratio("bytes", "tokens").alias("bytes_per_token"))


def top_tokens(encoded: DataFrame, vocab: DataFrame, k: int = 100) -> DataFrame:
    """The k most frequent token ids with their byte strings (bounded top-k)."""
    c = (encoded.select(F.explode("input_ids").alias("token_id"))
                .groupBy("token_id").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    top = c.orderBy(F.desc("n"), F.asc("token_id")).limit(k)
    return top.join(F.broadcast(vocab.select("token_id", "token")), "token_id")


# --- A4: tokenizer artifact --------------------------------------------------

def _bytes_to_unicode() -> dict[int, str]:
    """Byte-level alphabet for tokenizer.json: printable Latin-1 bytes map to themselves,
    the remaining bytes to code points from 256 upwards, in byte order (the public
    byte-level BPE convention)."""
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + \
        list(range(ord("®"), ord("ÿ") + 1))
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def tokenizer_json(merges) -> str:
    """A4: one tokenizer.json (byte-level BPE) for the trained merges."""
    tb = token_bytes(merges)
    b2u = _bytes_to_unicode()

    def s(i):
        return "".join(b2u[x] for x in tb[i])
    specials = {i for _, i in tx.SPECIAL_TOKENS}
    vocab = {(t if i in specials else s(i)): i for t, i in tx.SPECIAL_TOKENS}
    vocab.update({s(i): i for i in sorted(tb) if i not in specials})
    added = [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False,
              "normalized": False, "special": True} for t, i in tx.SPECIAL_TOKENS]
    bl = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    doc = {
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": added, "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": tx.PRETOKEN_RE}, "behavior": "Isolated", "invert": False},
            bl]},
        "post_processor": None, "decoder": bl,
        "model": {"type": "BPE", "dropout": None, "unk_token": "<unk>", "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                  "vocab": vocab, "merges": [[s(l), s(r)] for l, r, _ in merges]},
    }
    return json.dumps(doc, ensure_ascii=False)


def _commit_text(spark: SparkSession, path: str, text: str) -> None:
    """One file, whole or not at all: written beside its place, then renamed over it in the path's own file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = target.getFileSystem(conf).create(part, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, over)


def save_tokenizer(vocab: DataFrame, merges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: ``path/tokenizer.json``, one file committed by a rename, beside the tables ``vocab`` and ``merges``.

    Sizes are bounded by the vocabulary.  The file is written last: who finds it finds the tables.
    """
    vocab.coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    merges.coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    ml = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    _commit_text(vocab.sparkSession, f"{path}/tokenizer.json", tokenizer_json(ml))


def load_merges(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """The merges of a saved tokenizer, from its table."""
    m = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    return [(r["left_id"], r["right_id"], r["new_id"]) for r in m]


def merges_of_json(text: str) -> list[tuple[int, int, int]]:
    """(left, right, new) ids of a byte-level ``tokenizer.json``, in rank order."""
    model = json.loads(text)["model"]
    ids = model["vocab"]
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    return [(ids[l], ids[r], ids[l + r]) for l, r in pairs]


def load_tokenizer(spark: SparkSession, path: str) -> "BpeTokenizer":
    """The tokenizer of ``path/tokenizer.json``."""
    text = spark.read.text(f"{path}/tokenizer.json", wholetext=True).first()[0]
    return BpeTokenizer(merges_of_json(text))


class BpeTokenizer:
    """H1 plug-in for byte-level BPE."""

    def __init__(self, merges):
        self.merges = list(merges)

    @classmethod
    def train(cls, df: DataFrame, vocab_size: int = VOCAB_SIZE, **kw) -> "BpeTokenizer":
        _, m = train_bpe(df, vocab_size, **kw)
        return cls([(r["left_id"], r["right_id"], r["new_id"]) for r in m.orderBy("rank").collect()])

    def encode_df(self, df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        return bpe_encode(df, self.merges, text_col, id_col)

    def encode_columns(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        return encode_columns(df, bpe_ids(self.merges), cols)

