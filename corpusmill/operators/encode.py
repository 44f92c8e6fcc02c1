"""Word-level encoder (E2) and the tokenizer plug-in surface (H1).

The vocabulary is bounded by ``vocab_size`` (a parameter): it is sent to the
tasks, which encode whole documents where they are read.  No token row, no join and no shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx

VOCAB_SIZE = 25000


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): whitespace words with their corpus frequency (partial + final aggregation)."""
    return (df.select(F.explode(tx.words(text_col)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def word_vocab(df: DataFrame, vocab_size: int = VOCAB_SIZE, text_col: str = "text") -> DataFrame:
    """(token_id, word, n): the top (vocab_size - 3) words by (n desc, word asc) after the special ids."""
    k = vocab_size - len(tx.SPECIAL_TOKENS)
    top = word_counts(df, text_col).orderBy(F.desc("n"), F.asc("word")).limit(k)   # bounded top-k
    rank = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("word")))          # over <= k rows
    return top.select((rank + F.lit(len(tx.SPECIAL_TOKENS) - 1)).cast("int").alias("token_id"), "word", "n")


def encode_columns(df: DataFrame, ids_of, cols: dict[str, str]) -> DataFrame:
    """H1 over several text columns in one pass: ``df`` with an id array for each of them.

    ``cols``: text column -> name of its id array, which takes the text's place.  ``ids_of()`` is called in
    the task and returns a function from text to ids.  The other columns stay as they are; rows do not move.
    """
    names = [cols.get(c, c) for c in df.columns]
    src = df.select(*df.columns)
    schema = src.select(*[F.array().cast("array<int>").alias(cols[c]) if c in cols else F.col(c) for c in df.columns]).schema
    at = [i for i, c in enumerate(df.columns) if c in cols]

    def run(batches):
        encode = ids_of()
        for b in batches:
            out = list(b.columns)
            for i in at:
                out[i] = pa.array([encode(t or "") for t in b.column(i).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(out, names=names)
    return src.mapInArrow(run, schema)


def word_ids(vocab: DataFrame):
    """``ids_of`` of the word vocabulary, which is collected: its rows are bounded by the vocabulary size."""
    ids = {r["word"]: r["token_id"] for r in vocab.select("word", "token_id").collect()}

    def ids_of():
        words = re.compile(tx.WORD_RE)
        return lambda t: [ids.get(w, tx.UNK_ID) for w in words.findall(t)]
    return ids_of


def word_encode(df: DataFrame, vocab: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, input_ids, n_tokens) with unknown words -> <unk>.

    Documents without words (null text too) get an empty array.  ``id_col`` may be of any type, a struct too.
    """
    enc = encode_columns(df.select(F.col(id_col), F.col(text_col)), word_ids(vocab), {text_col: "input_ids"})
    return enc.withColumn("n_tokens", F.size("input_ids").cast("bigint"))


class WordTokenizer:
    """H1 plug-in: any object with ``encode_df(df, text_col, id_col)`` -> (id, input_ids, n_tokens)
    and ``encode_columns(df, {text column: id array column})``."""

    def __init__(self, vocab: DataFrame):
        self.vocab = vocab

    @classmethod
    def train(cls, df: DataFrame, vocab_size: int = VOCAB_SIZE, text_col: str = "text") -> "WordTokenizer":
        from corpusmill.operators.joins import materialize
        return cls(materialize(word_vocab(df, vocab_size, text_col)))

    def encode_df(self, df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        return word_encode(df, self.vocab, text_col, id_col)

    def encode_columns(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        return encode_columns(df, word_ids(self.vocab), cols)
