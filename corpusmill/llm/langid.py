"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram's vector is the
product of its letters' vectors, each rotated by its place in the n-gram
(binding); a text's vector is the sum over its n-grams (bundling); a language's
prototype is the sum of its training documents' vectors, each at unit length.
A document gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pieces, saved, sum_vectors
from corpusmill.session import prepare

DIM = 1024
SEED = 42
FOLDS, HELD_OUT = 4, 2
GAP = 32                     # any run of non-letters
GROUP_ROWS, GROUP_BYTES = 128, 1 << 20


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def rolled(code: int, dim: int, seed: int) -> np.ndarray:
    """A letter's vector as it stands third, second and first in a trigram."""
    v = np.random.default_rng([seed, code]).integers(0, 2, dim, np.int8) * 2 - 1
    return np.stack([np.roll(v, 2), np.roll(v, 1), v]).astype(np.int8)


def trigrams(text: str | None):
    """Distinct letter trigrams (three code points in one integer) and their counts; None without a letter."""
    if not text:
        return None
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[x]
    if not is_letter.any():
        return None
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]                   # the first of a run of non-letters stands for it
    x = np.where(is_letter, x, GAP)[keep].astype(np.uint64)
    x = np.concatenate([[GAP], x, [GAP]] if x[0] != GAP and x[-1] != GAP else [[GAP], x] if x[0] != GAP else [x, [GAP]]).astype(np.uint64)
    return np.unique((x[:-2] << np.uint64(42)) | (x[1:-1] << np.uint64(21)) | x[2:], return_counts=True)


def gram_vectors(codes: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """One row of +1 and -1 per trigram: the bound vectors of its letters."""
    mask = np.uint64((1 << 21) - 1)
    out = None
    for place, shift in enumerate((42, 21, 0)):
        own, at = np.unique((codes >> np.uint64(shift)) & mask, return_inverse=True)
        v = np.stack([rolled(int(c), dim, seed)[place] for c in own])[at]
        out = v if out is None else out * v
    return out


def bundle(counted: list, weights, dim: int, seed: int) -> np.ndarray:
    """Weighted sums of the documents' trigram vectors: weights (rows, documents) -> (rows, dim)."""
    codes, at = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
    m = np.zeros((len(counted), len(codes)), np.float32)
    doc = np.repeat(np.arange(len(counted)), [len(c) for c, _ in counted])
    m[doc, at] = np.concatenate([n for _, n in counted])
    if weights is not None:
        m = (weights @ m).astype(np.float32)
    return m @ gram_vectors(codes, dim, seed).astype(np.float32)


def groups(batches):
    """Arrow slices of bounded rows and bytes."""
    for b in pieces(batches, "text", GROUP_BYTES):
        for i in range(0, b.num_rows, GROUP_ROWS):
            yield b.slice(i, GROUP_ROWS)


def held_out(id_col: str = "doc_id"):
    """Is crc32(doc_id as text) mod 4 equal to 2?  A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def prototypes(train: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """{lang: unit vector} of ``train(text, lang)``; one vector per language and task leaves the tasks."""
    prepare(train.sparkSession)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in groups(batches):
            counted, langs = [], []
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if (g := trigrams(t)) is not None:
                    counted.append(g)
                    langs.append(lang)
            if not counted:
                continue
            own = sorted(set(langs))
            w = np.zeros((len(own), len(counted)))
            for i, (lang, (_, n)) in enumerate(zip(langs, counted)):
                w[own.index(lang), i] = 1 / np.sqrt(np.square(n, dtype=np.float64).sum())
            for lang, v in zip(own, bundle(counted, w, dim, seed)):
                sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
            if len(sums) > 4096:
                yield rows(sums)
                sums = {}
        if sums:
            yield rows(sums)

    def rows(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "vec"])
    parts = saved(train.select("text", "lang").where("lang is not null and text is not null").mapInArrow(run, "lang string, vec binary"), "lang-parts")
    out = {r["lang"]: np.frombuffer(r["vec"], np.float64) for r in sum_vectors(parts, "lang", "vec", dim).collect()}
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(out.items())}


def identify(docs: DataFrame, profile: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             dim: int = DIM, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin) for every row of ``docs``.

    score: the cosine with the best prototype, not below 0; margin: by how
    much it beats the second.  Ties go to the first language in code-point order.
    ``und`` with score 0 for null text and text without a letter, or where no
    language was learned.  Rows are judged one by one; an empty table gives an
    empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    names = list(profile)
    matrix = np.stack(list(profile.values())).astype(np.float32) if names else None
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, margin double"

    def run(batches):
        for b in groups(batches):
            pred, score, margin = ["und"] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)
            counted = [(i, g) for i, t in enumerate(b.column(2).to_pylist()) if (g := trigrams(t)) is not None]
            if counted and names:
                v = bundle([g for _, g in counted], None, dim, seed)
                cos = (v @ matrix.T) / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
                for (i, _), c in zip(counted, cos):
                    k = int(c.argmax())
                    pred[i], score[i] = names[k], min(1.0, max(0.0, float(c[k])))
                    margin[i] = float(c[k] - np.delete(c, k).max()) if len(c) > 1 else 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred), pa.array(score), pa.array(margin)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "margin"])
    return src.mapInArrow(run, schema)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn prototypes from the rows that are not held out and have a language, then judge every row."""
    train = docs.where(~held_out(id_col)).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return identify(docs, prototypes(train), id_col, text_col)
