"""Masked pseudo-likelihood: documents scored by a bidirectional window network.

Every token of a document is hidden in turn and predicted from the ``WINDOW``
tokens on either side; the summed conditional log-probabilities score the
document.  The vocabulary holds the most frequent words of the whole corpus; all others share hash
buckets, and within a bucket each word type of the corpus is as likely as another.

The network: context embeddings, scaled by position, summed and squashed, then
a two-level softmax (64 classes of 64 tokens, by frequency).  It is trained in
numpy inside the tasks, on every token of every document: positions are dealt to ``MASK`` sets, the sets
to the rounds; in each round every task hides its sets of positions in turn, in all its texts,
and takes gradient steps from the shared parameters; the tasks' results are averaged,
weighted by positions, through a shuffled tree.  After all rounds (of up to ``MASK``) each position was hidden once.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pieces, saved, sum_vectors
from corpusmill.session import prepare

CLASS = 64
TOKENS = CLASS * CLASS
BUCKETS = 256
PAD = TOKENS
DIM = 32
WINDOW = 2
MASK = 8
ROUNDS = 2
RUN = 256                    # neighbouring positions that are dealt to the same set
BATCH = 8192
RATE = 0.2
SCORED = 1 << 15             # positions scored at a time
PIECE = 512                  # rows whose 64 logits stay in a core's cache
LARGEST = 80                 # exp of a larger 32-bit number overflows
BLOCKS = 16                  # pieces that the parameters are averaged in
COUNTER = 200_000
SHAPES = {"emb": (TOKENS + 1, DIM), "place": (2 * WINDOW, DIM), "bias": (DIM,), "top": (CLASS, DIM), "top_b": (CLASS,),
          "low": (CLASS, CLASS, DIM), "low_b": (CLASS, CLASS)}
OFFSETS = [o for o in range(-WINDOW, WINDOW + 1) if o]


def initial(counts: np.ndarray, seed: int = 42) -> dict:
    """Small random weights; the output biases are the corpus's token frequencies."""
    rng = np.random.default_rng(seed)
    p = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in SHAPES.items()}
    p["place"] = np.ones(SHAPES["place"], np.float32)
    p["bias"] = np.zeros(SHAPES["bias"], np.float32)
    n = np.maximum(counts, 0.5).reshape(CLASS, CLASS)
    p["top_b"], p["low_b"] = (np.log(x).astype(np.float32) for x in (n.sum(1) / n.sum(), n / n.sum(1, keepdims=True)))
    return p


def flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float64)


def shaped(v: np.ndarray) -> dict:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = v[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def by_class(target: np.ndarray):
    """Order by class, and (class, start, end) of each class in that order."""
    c = (target // CLASS).astype(np.uint8)
    order = np.argsort(c, kind="stable")
    cut = np.searchsorted(c[order], np.arange(CLASS + 1))
    return order, [(k, cut[k], cut[k + 1]) for k in range(CLASS) if cut[k] < cut[k + 1]]


def log_probs(p: dict, tables: list, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log p(ids[at] | the tokens around) for positions ``at`` of a padded sequence; tables: embeddings scaled by place."""
    n, target, count, ones = len(at), ids[at], np.arange(PIECE), np.ones(CLASS, np.float32)
    h, out, own = np.empty((n, DIM), np.float32), np.empty(n, np.float32), target // CLASS
    for i in range(0, n, PIECE):
        here, z = at[i:i + PIECE], h[i:i + PIECE]
        z[:] = p["bias"]
        for t, o in zip(tables, OFFSETS):
            z += t.take(ids[here + o], 0)
        np.tanh(z, out=z)
        x = z @ p["top"].T
        x += p["top_b"]
        out[i:i + PIECE] = x[count[:len(x)], own[i:i + PIECE]]
        out[i:i + PIECE] -= np.log(np.exp(x, out=x) @ ones)
    order, runs = by_class(target)
    h, inner, low = h.take(order, 0), (target % CLASS)[order], np.empty(n, np.float32)
    for k, first, end in runs:
        for i in range(first, end, PIECE):
            j = min(i + PIECE, end)
            x = h[i:j] @ p["low"][k].T
            x += p["low_b"][k]
            low[i:j] = x[count[:j - i], inner[i:j]]
            low[i:j] -= np.log(np.exp(x, out=x) @ ones)
    out[order] += low
    return out


def softmax(x: np.ndarray, bias: np.ndarray, wide: bool = True) -> np.ndarray:
    """Of each row of ``x + bias``; in place.  ``wide``: a sum may pass ``LARGEST``."""
    x += bias
    if wide:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def largest(weights: np.ndarray, bias: np.ndarray) -> float:
    """No logit of these weights passes it: the hidden values are -1 to 1."""
    return float((np.abs(weights).sum(-1) + np.abs(bias)).max())


def scaled(p: dict) -> list:
    return [p["emb"] * s for s in p["place"]]


def keep_memory() -> None:
    """Freeing one large array tells glibc to keep up to twice its size, so steps do not ask the system for their arrays again and again."""
    np.empty(30 << 20, np.uint8)


class Trainer:
    """Gradient steps with per-parameter rates (Adagrad) from given parameters."""

    def __init__(self, p: dict):
        self.p, self.seen = {k: v.copy() for k, v in p.items()}, {k: np.full(v.shape, 1e-8, np.float32) for k, v in p.items()}

    def apply(self, name, grad, rows=None):
        a, p = self.seen[name], self.p[name]
        if rows is None:
            a += grad * grad
            p -= RATE * grad / np.sqrt(a)
        elif isinstance(rows, int):             # a view, no gather
            a[rows] += grad * grad
            p[rows] -= RATE * grad / np.sqrt(a[rows])
        else:
            own = a[rows]
            own += grad * grad
            a[rows] = own
            np.sqrt(own, out=own)
            p[rows] -= np.divide(RATE * grad, own, out=own)

    def step(self, ids: np.ndarray, at: np.ndarray) -> None:
        """One step on the ascending positions ``at``."""
        p, n = self.p, len(at)
        # The positions and those around, numbered without gaps: a neighbour's number is as far off as the neighbour.
        low = at[0] - WINDOW
        near = np.zeros(at[-1] + WINDOW + 1 - low, bool)
        for o in (0, *OFFSETS):
            near[at + (o - low)] = True
        word = ids[low:low + len(near)][near]
        around = p["emb"].take(word, 0)
        beside = [around[WINDOW + o:len(around) - WINDOW + o] for o in OFFSETS]
        target = ids[at]
        order, runs = by_class(target)
        target = target[order]
        own, inner = target // CLASS, target % CLASS
        here = (np.cumsum(near, dtype=np.int32) - 1 - WINDOW)[at - low][order]
        z = np.empty_like(beside[0])
        for i in range(0, len(z), PIECE):
            z[i:i + PIECE] = p["bias"]
            for x, s in zip(beside, p["place"]):
                z[i:i + PIECE] += x[i:i + PIECE] * s
        h = np.tanh(z.take(here, 0))
        dh, count, ones = np.empty_like(h), np.arange(n), np.ones(n, np.float32)
        top, top_b = np.zeros_like(p["top"]), np.zeros_like(p["top_b"])
        wide = largest(p["top"], p["top_b"]) > LARGEST
        for i in range(0, n, PIECE):
            x = h[i:i + PIECE]
            y = softmax(x @ p["top"].T, p["top_b"], wide)
            y[count[:len(x)], own[i:i + PIECE]] -= 1
            np.matmul(y, p["top"], out=dh[i:i + PIECE])
            top += y.T @ x
            top_b += ones[:len(x)] @ y
        inside, inside_b = np.zeros_like(p["low"]), np.zeros_like(p["low_b"])      # a gradient of zero changes nothing
        wide = largest(p["low"], p["low_b"]) > LARGEST
        for k, first, end in runs:
            for i in range(first, end, PIECE):
                j = min(i + PIECE, end)
                y = softmax(h[i:j] @ p["low"][k].T, p["low_b"][k], wide)
                y[count[:j - i], inner[i:j]] -= 1
                dh[i:j] += y @ p["low"][k]
                inside[k] += y.T @ h[i:j]
                inside_b[k] += ones[:j - i] @ y
        for name, grad in (("low", inside), ("low_b", inside_b), ("top", top), ("top_b", top_b)):
            grad /= n
            self.apply(name, grad)
        h *= h
        np.subtract(1, h, out=h)
        h *= dh
        h /= n
        self.apply("bias", ones @ h)
        d = np.zeros_like(beside[0])               # zero where a position is only a neighbour
        d[here] = h
        place = np.stack([np.einsum("ij,ij->j", d, x) for x in beside])
        g = np.zeros_like(around)
        for i in range(0, len(d), PIECE):
            x = d[i:i + PIECE]
            for o, s in zip(OFFSETS, p["place"]):
                g[WINDOW + o + i:WINDOW + o + i + len(x)] += x * s
        word = word.astype(np.uint16)              # 16 bits: sorted by counting
        order = np.argsort(word, kind="stable")
        word = word[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        self.apply("emb", np.add.reduceat(g.take(order, 0), first, axis=0), word[first])
        self.apply("place", place)


def padded(seqs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences in one array with ``WINDOW`` pads between; positions of the tokens; number per sequence."""
    sizes = np.array([len(s) for s in seqs], np.int64)
    out = np.full(int(sizes.sum()) + WINDOW * (len(seqs) + 1), PAD, np.int64)
    begin = np.cumsum(sizes + WINDOW) - sizes
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    if len(at):
        out[at] = np.concatenate(seqs)
    return out, at, sizes


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents; tasks pass partial counts on when they hold many words."""
    def run(batches):
        count: Counter = Counter()
        for b in pieces(batches, "text"):
            for t in b.column(0).to_pylist():
                if t:
                    count.update(t.lower().split())
                if len(count) > COUNTER:
                    yield rows(count)
                    count = Counter()
        yield rows(count)

    def rows(count):
        return pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], names=["word", "n"])
    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text_col: str = "text") -> tuple[dict, np.ndarray, np.ndarray]:
    """({word: id} of the most frequent words, corpus count per id, log of the number of word types per bucket)."""
    counts = saved(word_counts(docs, text_col), "lm-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(TOKENS - BUCKETS).collect()
    types, n = np.zeros(BUCKETS), np.zeros(TOKENS)
    first = TOKENS - BUCKETS
    for r in counts.groupBy((F.crc32(F.col("word").cast("binary")) % BUCKETS).alias("b")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")).collect():
        types[r["b"]], n[first + r["b"]] = r["types"], r["n"]
    for i, r in enumerate(top):                  # the frequent words are not in a bucket
        b = zlib.crc32(r["word"].encode()) % BUCKETS
        types[b] -= 1
        n[first + b] -= r["n"]
        n[i] = r["n"]
    return {r["word"]: i for i, r in enumerate(top)}, n, np.log(np.maximum(types, 1.0))


class Ids(dict):
    """The ids of the frequent words, and of up to ``COUNTER`` others that were met: the number of their bucket."""

    def __init__(self, vocab: dict):
        super().__init__(vocab)
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        if len(self) >= len(self.vocab) + COUNTER:
            self.clear()
            self.update(self.vocab)
        i = self[word] = TOKENS - BUCKETS + zlib.crc32(word.encode()) % BUCKETS
        return i


def encode(docs: DataFrame, vocab: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): little-endian 16-bit token ids of whole texts; null and empty texts have none."""
    def run(batches):
        id_of = Ids(vocab).__getitem__
        for b in pieces(batches, "text"):
            out = []
            for t in b.column(1).to_pylist():
                words = (t or "").lower().split()
                out.append(np.fromiter(map(id_of, words), np.int16, len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "ids"])
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids binary")


def sequences(column) -> list:
    return [np.frombuffer(x, np.int16) for x in column.to_pylist()]


def hidden(at: np.ndarray, r: int, rounds: int) -> list:
    """The sets of positions that round ``r`` of ``rounds`` hides, one after the other; more than ``MASK`` rounds begin anew.

    ``RUN`` neighbours are dealt together.  A position is never among those that it is predicted from.
    """
    own, n = (at // RUN * 2654435761 >> 7) % MASK, min(rounds, MASK)
    return [at[own == k] for k in range(r % n, MASK, n)]


def train(encoded: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, seed: int = 42) -> dict:
    """Parameters after ``rounds`` rounds over all documents, which hide every position between them."""
    p = initial(counts, seed)
    for r in range(rounds):
        start = flat(p)

        def run(batches, p=p, r=r):
            keep_memory()
            t, n = Trainer(p), 0
            for b in pieces(batches, "ids", 1 << 20):
                ids, at, _ = padded(sequences(b.column(0)))
                for own in hidden(at, r, rounds):
                    for i in range(0, len(own), BATCH):
                        t.step(ids, own[i:i + BATCH])
                    n += len(own)
            if n:
                v = np.append(flat(t.p) * n, n)
                yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([np.append(x, n).tobytes() for x in np.array_split(v[:-1], BLOCKS)], pa.binary())], names=["block", "vec"])
        parts = saved(encoded.select("ids").mapInArrow(run, "block int, vec binary"), "lm-parts")
        sums = {x["block"]: np.frombuffer(x["vec"], np.float64) for x in sum_vectors(parts, "block", "vec", DIM).collect()}
        if not sums:                             # no text has a position of this round
            continue
        v = np.concatenate([sums[k][:-1] / sums[k][-1] for k in range(BLOCKS)])
        p = shaped(v if len(v) == len(start) else start)
    return p


def score(encoded: DataFrame, p: dict, log_types: np.ndarray) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood): every token of every document predicted once."""
    schema = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, log_likelihood double, mean_log_likelihood double"

    def run(batches):
        keep_memory()
        tables, first = scaled(p), TOKENS - BUCKETS
        for b in pieces(batches, "ids", 1 << 20):
            ids, at, sizes = padded(sequences(b.column(1)))
            lp = np.empty(len(at))
            for i in range(0, len(at), SCORED):
                lp[i:i + SCORED] = log_probs(p, tables, ids, at[i:i + SCORED])
            rare = ids[at] >= first
            lp[rare] -= log_types[ids[at[rare]] - first]
            total = np.zeros(len(sizes))
            full = sizes > 0
            if full.any():
                total[full] = np.add.reduceat(lp, (np.cumsum(sizes) - sizes)[full])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(total), pa.array(total / np.maximum(sizes, 1), mask=~full)],
                                             names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on all of ``docs`` and score every row: (doc_id, n_tokens, log_likelihood, mean_log_likelihood).

    Tokens are the lower-case words between white space.  Null, empty and blank texts have no
    token: log_likelihood 0, mean null.  Repeated rows are trained on and scored as often as they are there;
    an empty table gives an empty result; columns other than the two named are not read.
    """
    prepare(docs.sparkSession)
    vocab, counts, log_types = vocabulary(docs, text_col)
    encoded = saved(encode(docs, vocab, id_col, text_col), "lm-ids")
    return score(encoded, train(encoded, counts, rounds), log_types)
