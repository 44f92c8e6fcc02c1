"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

The test items are indexed (impact-ordered bounds per posting block), and every
passage of every document is a query.  Impacts are divided by the item's own
score, so that an item that is wholly in a passage scores one and one
threshold serves all items.  What is retrieved is verified on the words of the
item's question and answer.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pieces, saved
from corpusmill.session import prepare

K1, B = 1.2, 0.75
THRESHOLD = 0.6              # of an item's own score; an item with four fifths of its shingles scores more
OVERLAP = 0.8
SHINGLE = 5
POSTING_BLOCK = 64
RANGES = 64                  # ranges of items with bounds of their own
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20     # what one index, sent to the executors, may hold at most (about)
WORD = re.compile(r"\w+")
END = 1 << 60


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def shingles(w: list) -> set:
    """Runs of five words; of fewer words the whole sequence."""
    return {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and the answer of an item.

    The question runs to the last question mark that something follows, else to the end of the last but
    one sentence, else to the middle word.  An answer of under eight words is read with the words before it, so
    that it can be told from chance; an item of under 16 words is question and answer at once.
    """
    at = text.rstrip().rfind("?", 0, len(text.rstrip()) - 1)
    if at < 0:
        ends = [m.end() for m in re.finditer(r"[.!?。]\s+(?=\S)", text)]
        at = ends[-1] - 1 if ends else -1
    both = words(text)
    q = words(text[:at + 1]) if at >= 0 else both[:len(both) // 2]
    if len(both) < 16:
        return both, both
    cut = min(max(len(q), 8), len(both) - 8)
    return both[:cut], both[cut:]


class Postings:
    """One term's items in order, their impacts, and the largest impact of each block."""

    def __init__(self, items: list[int], impacts: list[float]):
        self.items, self.impacts, self.best = items, impacts, max(impacts)
        self.block_best = [max(impacts[i:i + POSTING_BLOCK]) for i in range(0, len(impacts), POSTING_BLOCK)]


class Index:
    """Items of similar length (at most ``span`` words) with their postings."""

    def __init__(self, span: int, items: list, vocabulary: dict, idf: dict, mean_len: float):
        self.span, self.ids = span, [i for i, _ in items]
        found: dict[str, list] = {}
        self.parts = []
        for at, (_, text) in enumerate(items):
            w = words(text)
            q, a = question_answer(text)
            self.parts.append((shingles(w), shingles(q), shingles(a)))
            norm = K1 * (1 - B + B * len(w) / mean_len)
            weight = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in Counter(w).items()}
            total = sum(weight.values())
            for t, x in weight.items():
                found.setdefault(t, []).append((at, x / total))
        self.local = np.full(len(vocabulary), -1, np.int64)
        self.local[[vocabulary[t] for t in found]] = np.arange(len(found))
        self.postings = [Postings([i for i, _ in p], [x for _, x in p]) for p in found.values()]
        self.bound = np.array([p.best for p in self.postings])
        # The same bound by range of items: what a passage can score within the range.
        width = -(-len(items) // RANGES)
        self.by_range = np.zeros((len(self.postings), -(-len(items) // width)), np.float32)
        for t, p in enumerate(self.postings):
            np.maximum.at(self.by_range[t], np.array(p.items) // width, np.array(p.impacts, np.float32) * 1.000001)

    def retrieve(self, terms: list[int], theta: float) -> list[tuple[int, float]]:
        """Block-max WAND: every (item, score) with score >= theta for a passage of these distinct terms."""
        theta -= 1e-9
        cur = [[self.postings[t].items[0], 0, self.postings[t]] for t in terms]
        out = []

        def seek(c, item):
            items, i = c[2].items, c[1]
            if c[0] >= item:
                return
            step, n = 1, len(items)
            while i + step < n and items[i + step] < item:
                step *= 2
            lo, hi = i + step // 2, min(i + step, n)
            while lo < hi:
                mid = (lo + hi) // 2
                if items[mid] < item:
                    lo = mid + 1
                else:
                    hi = mid
            c[1] = lo
            c[0] = items[lo] if lo < n else END

        while cur:
            cur.sort(key=lambda c: c[0])
            while cur and cur[-1][0] == END:
                cur.pop()
            reach, pivot = 0.0, -1
            for k, c in enumerate(cur):
                reach += c[2].best
                if reach >= theta:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = cur[pivot][0]
            while pivot + 1 < len(cur) and cur[pivot + 1][0] == item:
                pivot += 1
            # Bound by the blocks that hold (or would hold) the pivot item.
            reach, past = 0.0, cur[pivot + 1][0] if pivot + 1 < len(cur) else END
            for c in cur[:pivot + 1]:
                p, b = c[2], c[1] // POSTING_BLOCK
                while (b + 1) * POSTING_BLOCK <= len(p.items) and p.items[(b + 1) * POSTING_BLOCK - 1] < item:
                    b += 1
                if b < len(p.block_best):
                    reach += p.block_best[b]
                    past = min(past, p.items[min((b + 1) * POSTING_BLOCK, len(p.items)) - 1] + 1)
            if reach < theta:
                past = max(past, item + 1)
                for c in cur[:pivot + 1]:
                    seek(c, past)
            elif cur[0][0] == item:
                score = sum(c[2].impacts[c[1]] for c in cur[:pivot + 1])
                if score >= theta:
                    out.append((item, score))
                for c in cur[:pivot + 1]:
                    seek(c, item + 1)
            else:
                for c in cur[:pivot]:
                    seek(c, item)
        return out

    def leaks(self, w: list[str], ids: np.ndarray, theta: float, overlap: float):
        """(item position, score, overlap, question overlap, answer overlap, passages) of a document's words.

        ``ids``: the words' numbers in the block's vocabulary, -1 for words of no item.
        """
        s, low = self.span, theta - 1e-4         # the bounds are sums of rounded numbers
        # A passage is two chunks of ``span`` words; every run of span + 1 words lies in one.
        at = np.flatnonzero(ids >= 0)
        term = self.local[ids[at]]
        at, term = at[term >= 0], term[term >= 0]
        if not len(at):
            return []
        key = np.sort(at // s * len(self.postings) + term)
        key = key[np.append(True, key[1:] != key[:-1])]
        chunk, term = key // len(self.postings), key % len(self.postings)
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        chunk, ends = chunk[first], np.append(first[1:], len(key))
        follows = np.append(chunk[1:] == chunk[:-1] + 1, False)
        total = np.add.reduceat(self.bound[term], first)
        fits = total + np.where(follows, np.append(total[1:], 0.0), 0.0) >= low
        if not fits.any():
            return []
        used = fits | np.append(False, (fits & follows)[:-1])
        # The same by range of items, for the chunks that are left.
        sizes = (ends - first)[used]
        rows = self.by_range[term[np.repeat(used, ends - first)]]
        ranges = np.zeros((len(chunk), rows.shape[1]), np.float32)
        ranges[used] = np.add.reduceat(rows, np.append(0, np.cumsum(sizes)[:-1]), axis=0)
        fits &= (ranges + np.where(follows[:, None], np.append(ranges[1:], ranges[:1], axis=0), 0)).max(1) >= low
        near = np.flatnonzero(fits)
        best: dict[int, list] = {}
        for c in near.tolist():
            j, more = int(chunk[c]), follows[c]
            lo, hi = j * s, min((j + 2) * s, len(w))
            terms = np.unique(term[first[c]:ends[c + 1] if more else ends[c]])
            if self.bound[terms].sum() < low or self.by_range[terms].sum(0).max() < low:
                continue
            hits = self.retrieve(terms.tolist(), theta)
            if not hits:
                continue
            around = w[max(0, lo - s):hi + s]
            seen = shingles(around)
            # Items of fewer words than a shingle have one run, of their length: it may begin at any word, the last ones too.
            sizes = {len(g) for i, _ in hits for g in self.parts[i][0] if len(g) < SHINGLE}
            short = {tuple(around[j:j + k]) for k in sizes for j in range(len(around) - k + 1)}
            for i, score in hits:
                every, q, a = (sum(g in seen or (len(g) < SHINGLE and g in short) for g in p) / len(p) for p in self.parts[i])
                if every >= overlap and q >= overlap / 2 and a >= overlap / 2:
                    old = best.setdefault(i, [score, every, q, a, 0])
                    old[:4] = [max(x, y) for x, y in zip(old[:4], (score, every, q, a))]
                    old[4] += 1
        return [(i, *v) for i, v in sorted(best.items())]


class Block:
    """A bounded block of items: one vocabulary, an index per class of lengths."""

    def __init__(self, items: list, idf: dict, mean_len: float):
        self.vocabulary = {t: k for k, t in enumerate(idf)}
        by_span: dict[int, list] = {}
        for i, t in items:
            by_span.setdefault(max(32, 1 << (len(words(t)) - 1).bit_length()), []).append((i, t))
        self.indexes = [Index(s, x, self.vocabulary, idf, mean_len) for s, x in sorted(by_span.items())]

    def leaks(self, text: str | None, theta: float, overlap: float) -> list[tuple]:
        """(item_id, score, overlap, question overlap, answer overlap, passages) of one text."""
        w = words(text)
        if not w:
            return []
        get = self.vocabulary.get
        ids = np.array([get(x, -1) for x in w], np.int64)
        return [(ix.ids[i], *x) for ix in self.indexes for i, *x in ix.leaks(w, ids, theta, overlap)]


def build_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Block]:
    """The items in blocks; term statistics are those of all items.

    Items without a word are left out.  A block holds about ``BLOCK_ITEMS``
    items and ``BLOCK_BYTES`` of text, so what is sent to executors is bounded
    however many items there are; every block is searched.
    """
    prepare(benchmark.sparkSession)
    items = saved(benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
                  .where(F.col("text").rlike(r"(?U)\w")), "bench-items")
    if items.limit(1).count() == 0:
        return []

    def split(batches):
        for b in batches:
            for t in b.column(0).to_pylist():
                w = words(t)
                if w:
                    yield pa.RecordBatch.from_arrays([pa.array(sorted(set(w))), pa.array([len(w)] + [0] * (len(set(w)) - 1), pa.int64())], names=["term", "n"])
    tokens = saved(items.select("text").mapInArrow(split, "term string, n bigint").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("n").alias("n")), "bench-terms")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    mean_len = tokens.agg(F.sum("n")).first()[0] / size["n"]
    blocks = max(math.ceil(size["n"] / BLOCK_ITEMS), math.ceil(size["b"] / BLOCK_BYTES))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = []
    for k in range(blocks):
        own = sorted(((r["item_id"], r["text"]) for r in dealt.where(F.col("block") == k).toLocalIterator()),
                     key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        own = [(i, t) for i, t in own if words(t)]
        if not own:
            continue
        vocabulary = {t for _, text in own for t in words(text)}
        spark = benchmark.sparkSession
        df = {r["term"]: r["df"] for r in tokens.join(F.broadcast(
            spark.createDataFrame([(t,) for t in vocabulary], "term string")), "term").toLocalIterator()}
        idf = {t: math.log(1 + (size["n"] - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        out.append(Block(own, idf, mean_len))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap, passages): one row per leak.

    A row of ``docs`` leaks an item if a passage of it scores at least
    ``threshold`` of the item's own BM25 score, at least ``overlap`` of the
    item's five-word shingles are there, and at least half of that of its question's
    and of its answer's.  Whole texts are searched.  Null or empty texts and
    items without words leak nothing; repeated documents are reported row by row;
    an item that is there twice under one id counts once; empty tables
    give an empty result; other columns are not read.  Documents are scanned
    once per block of items and nothing is shuffled.
    """
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, item_id {item_type}, score double, overlap double, " \
             "question_overlap double, answer_overlap double, passages bigint"
    out = None
    for block in build_blocks(benchmark, item_col):
        def run(batches, block=block):
            for b in pieces(batches, "text"):
                rows = []
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    rows += [(d, *x) for x in block.leaks(t, threshold, overlap)]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "passages"), r)) for r in rows])
        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that leak no item, columns unchanged: one pass per block of items, no shuffle."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)
    for block in build_blocks(benchmark, item_col):
        def run(batches, block=block):
            for b in pieces(batches, text_col):
                yield b.filter(pa.array([not block.leaks(t, threshold, overlap) for t in b.column(at).to_pylist()], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
