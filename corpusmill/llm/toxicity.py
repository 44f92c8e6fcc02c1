"""Toxicity by maximum-scoring segments.

Tokens are scored by their log-odds between toxic and other documents,
smoothed with Dirichlet priors: a word's prior is centred on the words
that begin alike (six, five, four letters), theirs on the corpus.  A linear scan
(all maximal scoring subsequences) finds the passages where positive tokens
stand dense; an extreme-value law, fitted to clean documents, says how likely a
document of that length has such a passage by chance.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pieces, saved
from corpusmill.session import prepare

FOLDS, HELD_OUT = 3, 1
MAX_LABELS = 200_000         # labelled documents that the classifier is fitted on, at most
MAX_TOKENS = 100_000         # word and prefix features it keeps, those with the most evidence
PREFIXES = (4, 5, 6)
PRIOR = 20.0                 # pseudo-counts of the Dirichlet priors
MIN_EVIDENCE = 12.0          # log-likelihood ratio, over documents, that a feature needs
DRIFT = 1.0                  # taken off every token's log-odds, so that clean text scores below zero
THRESHOLD = 0.7
MAX_SURPRISE = 12.0
COPY = 0.8                   # Jaccard similarity of the runs of five tokens of two copies
COUNTER = 200_000
TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    """A word and its beginnings, longest first; a beginning ends in ``*``."""
    return [word, *(word[:k] + "*" for k in reversed(PREFIXES) if len(word) > k)]


class Scores(dict):
    """Token -> score; unknown tokens are looked up by their beginnings, then remembered (bounded)."""

    def __init__(self, weights: dict[str, float], drift: float):
        super().__init__()
        self.weights, self.drift = weights, drift

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        s = next((self.weights[f] for f in features(word) if f in self.weights), -self.drift)
        self[word] = s
        return s


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by the linear-time scan of Ruzzo and Tompa.

    Only positive scores open a segment, so the scan steps from one positive
    score to the next with the running total between them.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []                         # start, end, total before, total after, link
    for i in at.tolist():
        start, end, left, right = i, i + 1, total[i], total[i + 1]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:  # linked list of smaller left totals keeps this linear
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
            j = len(found) - 1
    return [(s, e, r - l) for s, e, l, r, _ in found]


def labelled(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, id_col: str = "doc_id",
             label_col: str = "toxic") -> DataFrame:
    """(doc_id, toxic) of training rows: fold not held out, labels of a repeated id by majority (a tie is toxic)."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    one = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold != HELD_OUT))
           .groupBy(F.col(id_col).alias("cm_label_id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("cm_toxic")))
    return saved(one.orderBy(F.xxhash64("cm_label_id"), "cm_label_id").limit(max_labels), "toxic-labels")


def run_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's runs of five tokens, in order."""
    w = tokens(text)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    k = min(5, len(h))
    if not k:
        return np.zeros(0, np.uint64)
    runs = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        runs = (runs ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(32)
    return runs


def sketches(runs: np.ndarray) -> tuple[int, int]:
    """Two min-hashes of the runs; copies agree in them, near copies mostly in one."""
    if not len(runs):
        return 0, 0
    return tuple(int(((runs ^ np.uint64(seed)) * np.uint64(0xC2B2AE3D27D4EB4F)).min().view(np.int64)) for seed in (1, 0x5851F42D4C957F2D))


def without_copies(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``known`` less the documents that copy another of the same label: copies would count as evidence many times.

    Equal token sequences count once.  Documents that agree in a min-hash are held against the
    first of them: one that shares ``COPY`` of its runs or more with it goes, one with a passage in common stays.
    """
    src = docs.select(F.col(id_col).alias("cm_label_id"), F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(known), "cm_label_id")

    def whole(t):
        return hashlib.blake2b(" ".join(tokens(t)).encode(), digest_size=16).digest()

    def sketched(batches):
        for b in pieces(batches, "text"):
            texts = b.column(1).to_pylist()
            m = [sketches(run_hashes(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(map(whole, texts), pa.binary()), *[pa.array([x[k] for x in m], pa.int64()) for k in (0, 1)]],
                                             names=["cm_label_id", "cm_toxic", "whole", "m0", "m1"])

    def sets(batches):
        for b in pieces(batches, "text"):
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(map(whole, texts), pa.binary()), pa.array([np.unique(run_hashes(t)).view(np.int64) for t in texts], pa.list_(pa.int64()))],
                                             names=["whole", "runs"])
    kind = known.schema["cm_label_id"].dataType.simpleString()
    src = src.select("cm_label_id", "text", "cm_toxic")
    left = saved(src.mapInArrow(sketched, f"cm_label_id {kind}, cm_toxic int, whole binary, m0 bigint, m1 bigint")
                    .groupBy("cm_toxic", "whole", "m0", "m1").agg(F.min("cm_label_id").alias("cm_label_id")), "toxic-distinct")
    met = []
    for m in ("m0", "m1"):
        first = left.groupBy("cm_toxic", m).agg(F.min(F.struct("cm_label_id", "whole")).alias("to"), F.count(F.lit(1)).alias("n")).where("n > 1")
        met.append(left.join(first, ["cm_toxic", m]).select("cm_toxic", "cm_label_id", "whole", F.col("to.cm_label_id").alias("to_id"), F.col("to.whole").alias("to")))
    met = saved(met[0].unionByName(met[1]).where("whole != to").distinct(), "toxic-met")
    # The runs of those that met only, from their texts.
    ids = saved(met.select("cm_label_id").union(met.select("to_id")).distinct(), "toxic-met-ids")
    runs = saved(src.join(F.broadcast(ids), "cm_label_id", "left_semi").select("cm_label_id", "text").mapInArrow(sets, "whole binary, runs array<bigint>")
                    .dropDuplicates(["whole"]), "toxic-runs")
    both = F.size(F.array_intersect("runs", "others"))
    gone = (met.join(runs, "whole").join(runs.select(F.col("whole").alias("to"), F.col("runs").alias("others")), "to")
               .where(both >= F.lit(COPY) * (F.size("runs") + F.size("others") - both)).select("cm_toxic", "whole"))
    left = left.join(saved(gone, "toxic-copies"), ["cm_toxic", "whole"], "left_anti")
    return saved(left.select("cm_label_id", "cm_toxic").distinct(), "toxic-known")


def fit_weights(train: DataFrame, max_tokens: int = MAX_TOKENS, prior: float = PRIOR) -> dict[str, float]:
    """Log-odds less ``DRIFT`` per feature of ``train(text, toxic)`` where positive, at most ``max_tokens`` of them."""
    def run(batches):
        count: dict = {}
        for b in pieces(batches, "text"):
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = tokens(t)
                own: dict = {}
                for w in words:
                    own[w] = own.get(w, 0) + 1
                by_feature: dict = {}
                for w, n in own.items():
                    for f in features(w):
                        by_feature[f] = by_feature.get(f, 0) + n
                by_feature[""] = len(words)
                for f, n in by_feature.items():
                    c = count.setdefault(f, [0, 0, 0, 0])
                    c[y] += n
                    c[2 + y] += 1
                if len(count) > COUNTER:
                    yield rows(count)
                    count = {}
        if count:
            yield rows(count)

    def rows(count):
        m = np.array(list(count.values()), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(list(count)), *[pa.array(m[:, k]) for k in range(4)]], names=["f", "n0", "n1", "d0", "d1"])
    counts = saved(train.select("text", "cm_toxic").mapInArrow(run, "f string, n0 bigint, n1 bigint, d0 bigint, d1 bigint")
                   .groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "d0", "d1")]), "toxic-counts")
    whole = counts.where("f = ''").first()
    if not whole or not whole["n0"] or not whole["n1"]:
        return {}
    base = float(whole["n1"]) / float(whole["n0"] + whole["n1"])
    # Features that toxic documents use more than the corpus, beyond what trying very many features finds by chance.
    docs1 = F.lit(float(whole["d1"]) / float(whole["d0"] + whole["d1"]))
    d = F.col("d0") + F.col("d1")
    evidence = F.col("d1") * F.log(F.col("d1") / (docs1 * d)) + \
        F.when(F.col("d0") > 0, F.col("d0") * F.log(F.col("d0") / ((1 - docs1) * d))).otherwise(0.0)
    top = (counts.where((F.col("f") != "") & (F.col("d1") > docs1 * d) & (F.col("n1") > F.lit(base) * (F.col("n0") + F.col("n1"))))
           .withColumn("evidence", evidence).where(F.col("evidence") >= MIN_EVIDENCE)
           .orderBy(F.desc("evidence"), "f").limit(max_tokens).collect())
    rate: dict[str, float] = {}
    out = {}
    for r in sorted(top, key=lambda r: (not r["f"].endswith("*"), len(r["f"]))):      # short beginnings first
        f = r["f"]
        up = next((rate[p] for p in features(f.rstrip("*")) if p != f and p in rate), base)
        rate[f] = (r["n1"] + prior * up) / (r["n0"] + r["n1"] + prior)
        odds = math.log(rate[f] / (1 - rate[f])) - math.log(base / (1 - base))
        if odds > DRIFT:
            out[f] = odds - DRIFT
    return out


class Law:
    """Extreme-value law of clean text: segments of score >= s come at ``rate * exp(-lam * (s - least))`` per token.

    ``slope`` and ``shift`` turn the surprise of a document (minus the
    decimal logarithm of its p-value) into the probability that it is toxic.
    """

    def __init__(self, lam: float, rate: float, least: float, slope: float = 1.0, shift: float = 0.0):
        self.lam, self.rate, self.least, self.slope, self.shift = lam, rate, least, slope, shift

    def expected(self, s, n: int):
        """Segments of at least this score that clean text of ``n`` tokens has."""
        return n * self.rate * np.exp(-self.lam * np.maximum(np.asarray(s, np.float64) - self.least, 0.0))

    def surprise(self, scores: list, n: int) -> float:
        """-log10 of the least chance, over r, that clean text has r segments as high as the r highest here."""
        if not scores:
            return 0.0
        mu = self.expected(sorted(scores, reverse=True), n)
        r = np.arange(1, len(mu) + 1)
        mu = np.clip(mu, 1e-300, 0.999 * r)      # where r are expected they are no surprise
        log_p = r * np.log(mu) - mu - np.cumsum(np.log(r)) - np.log1p(-mu / (r + 1))
        return float(min(MAX_SURPRISE, max(0.0, -log_p.min() / math.log(10))))

    def probability(self, surprise: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.shift + self.slope * surprise))))


def logistic(x: np.ndarray, y0: np.ndarray, y1: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Slope (not below 0) and shift of a logistic curve through counts of both labels at values ``x``."""
    f = np.stack([x, np.ones(len(x))], 1)

    def gain(w):
        z = f @ w
        return float(-(y1 * np.logaddexp(0, -z) + y0 * np.logaddexp(0, z)).sum() - ridge / 2 * w @ w)
    w = np.array([0.0, math.log((y1.sum() + 0.5) / (y0.sum() + 0.5))])
    for _ in range(100):                         # Newton's method, steps halved until they gain
        q = 1 / (1 + np.exp(-np.clip(f @ w, -50, 50)))
        n = y0 + y1
        step = np.linalg.solve((f * (n * q * (1 - q))[:, None]).T @ f + ridge * np.eye(2), f.T @ (y1 - n * q) - ridge * w)
        while gain(w + step) < gain(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def fit_calibration(train: DataFrame, weights: dict[str, float], drift: float = DRIFT) -> Law:
    """The law of the clean documents' segments, and the curve from surprise to probability over all of ``train``.

    Above the least score the segments' scores fall off exponentially: rate and decay are
    their maximum-likelihood values, with one segment more than was
    seen, so that the law is proper where clean documents have none.
    """
    scores = Scores(weights, drift)
    least = min(weights.values())

    def found(batches):
        for b in pieces(batches, "text"):
            rows = []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = tokens(t)
                rows.append({"y": y, "n": len(w), "s": [x for _, _, x in segments(np.fromiter(map(scores.__getitem__, w), np.float64, len(w)))]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("y", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.float64()))]))
    per_doc = saved(train.select("text", "cm_toxic").mapInArrow(found, "y int, n bigint, s array<double>"), "toxic-segments")
    clean = per_doc.where("y = 0").select("n", F.size("s").alias("c"), F.aggregate("s", F.lit(0.0), lambda a, v: a + F.greatest(v - F.lit(least), F.lit(0.0))).alias("e"))
    n, c, e = (float(v or 0) for v in clean.agg(F.sum("n"), F.sum("c"), F.sum("e")).first())
    law = Law((c + 1) / (e + 1), (c + 1) / max(n, 1.0), least)

    def surprises(batches):
        for b in batches:
            x = [round(law.surprise(s, n), 1) for n, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())], names=["y", "x"])
    hist = per_doc.mapInArrow(surprises, "y int, x double").groupBy("x").agg(F.sum(1 - F.col("y")).alias("y0"), F.sum("y").alias("y1")).orderBy("x").collect()
    x, y0, y1 = (np.array([float(r[k]) for r in hist]) for k in ("x", "y0", "y1"))
    law.slope, law.shift = logistic(x, y0, y1)
    return law


def score_documents(docs: DataFrame, weights: dict[str, float], law: Law, id_col: str = "doc_id",
                    text_col: str = "text", drift: float = DRIFT, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) for every row of ``docs``.

    passages: array of (start, end, p) in tokens, the maximal segments, with the
    chance that clean text of this length has one as high, where that is at most
    1 - threshold.  score: the calibrated probability of the
    document's surprise over all its segments together.  Null and empty texts have no
    segment and get the probability of a document without any.
    """
    prepare(docs.sparkSession)
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    src = docs.select(F.col(id_col).alias("doc_id"), fold.alias("held_out"), F.col(text_col).alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int, " \
             "passages array<struct<start:int,end:int,p:double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    scores = Scores(weights, drift)

    def run(batches):
        for b in pieces(batches, "text"):
            score, passages = [], []
            for t in b.column(2).to_pylist():
                w = tokens(t) if weights else []
                found = segments(np.fromiter(map(scores.__getitem__, w), np.float64, len(w)))
                score.append(law.probability(law.surprise([x for _, _, x in found], len(w))) if weights else 0.0)
                p = -np.expm1(-law.expected([x for _, _, x in found], len(w))) if found else []
                passages.append([{"start": a, "end": e, "p": float(q)} for (a, e, _), q in zip(found, p) if q <= 1 - threshold])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64()),
                                              pa.array([int(x >= threshold) for x in score], pa.int32()), pa.array(passages, kind)],
                                             names=["doc_id", "held_out", "score", "predicted", "passages"])
    return src.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             max_labels: int = MAX_LABELS) -> DataFrame:
    """Learn from the labelled rows that are not held out, then score every row of ``docs``.

    The classifier is fitted on at most ``max_labels`` labelled documents (those with the
    smallest hash of their id), which bounds what is sent to the executors;
    every document is scored in full.  Without both labels among them nothing is toxic: score 0.
    Rows that repeat an id are scored one by one; an empty table gives an
    empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    known = without_copies(docs, labelled(docs, labels, max_labels, id_col, label_col), id_col, text_col)
    train = saved(docs.select(F.col(id_col).alias("cm_id"), F.col(text_col).alias("text")).where("text is not null")
                  .join(F.broadcast(known), F.col("cm_id") == F.col("cm_label_id")).select("text", "cm_toxic"), "toxic-train")
    weights = fit_weights(train)
    law = fit_calibration(train, weights) if weights else Law(1.0, 1.0, 0.0)
    return score_documents(docs, weights, law, id_col, text_col)
