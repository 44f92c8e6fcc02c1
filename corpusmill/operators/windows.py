"""Overlapping fixed-length windows, global sample index, batches, collation.

Windows are per document (no window spans two documents).  With stride
S = L - O a document of n tokens yields 0 windows if n = 0, 1 if n <= L,
else 1 + ceil((n - L) / S); window i is tokens [i*S, i*S + L) and the last
one may be short.  Everything is array/integer expressions - no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.prefix import in_order, offsets_in_place, running_offsets

MAX_SEQ_LENGTH = 512
OVERLAP = MAX_SEQ_LENGTH // 4
BATCH_SIZE = 64
NUM_EPOCHS = 6
ACCUM_STEPS = 8
LOG_INTERVAL = 50
SAVE_INTERVAL = 10000
VAL_CAP = 5000
NUM_WORKERS = 4


def _stride(max_seq_length: int, overlap_size: int) -> int:
    if not (0 <= overlap_size < max_seq_length):
        raise ValueError("need 0 <= overlap_size < max_seq_length (stride must be positive)")
    return max_seq_length - overlap_size


def window_count(n, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP) -> "F.Column":
    """E3/E4 arithmetic: number of windows for a document of n tokens."""
    s = _stride(max_seq_length, overlap_size)
    n = tx.col_(n).cast("bigint")
    return (F.when(n <= 0, F.lit(0))
             .when(n <= max_seq_length, F.lit(1))
             .otherwise(F.lit(1) + F.call_function("div", n - max_seq_length + (s - 1), F.lit(s)))).cast("bigint")


def _explode_windows(df: DataFrame, ids_col: str, max_seq_length: int, overlap_size: int) -> DataFrame:
    s = _stride(max_seq_length, overlap_size)
    nwin = window_count(F.size(ids_col), max_seq_length, overlap_size)
    ixs = F.when(nwin > 0, F.sequence(F.lit(0), (nwin - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    keep = [c for c in df.columns if c not in (ids_col, "n_tokens")]
    out = (df.select(*keep, ids_col, F.explode(ixs).alias("window_ix"))
             .withColumn(ids_col, F.slice(ids_col, F.col("window_ix") * s + 1, max_seq_length))
             .withColumn("n_tokens", F.size(ids_col).cast("bigint")))
    return out


def windows(encoded: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP,
            ids_col: str = "input_ids") -> DataFrame:
    """(doc_id, window_ix, input_ids, n_tokens) per document."""
    return _explode_windows(encoded, ids_col, max_seq_length, overlap_size)


def unwindowed(windows_df: DataFrame, overlap_size: int = OVERLAP, id_col: str = "doc_id", ids_col: str = "input_ids") -> DataFrame:
    """The inverse of E3: (doc_id, input_ids) per document, from its windows in any order.

    Every window but the first begins with ``overlap_size`` tokens of the one before.  Padded windows
    are cut to ``n_tokens`` first.  A document's windows meet in one row, which is its whole token array.
    """
    own = F.slice(ids_col, 1, F.col("n_tokens").cast("int"))
    new = F.when(F.col("window_ix") == 0, own).otherwise(F.slice(own, overlap_size + 1, F.greatest(F.size(own), F.lit(1))))
    parts = F.array_sort(F.collect_list(F.struct("window_ix", new.alias("ids"))))
    return windows_df.groupBy(id_col).agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias(ids_col))


def sample_count(encoded: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP,
                 by=(), n_col: str = "n_tokens") -> DataFrame:
    """Total samples (and documents, tokens) without materialising a window."""
    nw = window_count(F.col(n_col), max_seq_length, overlap_size)
    return (encoded.groupBy(*by)
                   .agg(F.count(F.lit(1)).cast("bigint").alias("documents"),
                        F.sum(F.col(n_col)).cast("bigint").alias("tokens"),
                        F.sum(nw).cast("bigint").alias("samples")))


def indexed_windows(encoded: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP,
                    ids_col: str = "input_ids", id_col: str = "doc_id", order_cols=None) -> DataFrame:
    """E3 + E5: windows carrying a dense global ``sample_id`` in (doc_id, window_ix) order.

    For rows that are encoded already, wherever they lie: the running window count costs a range
    shuffle of the encoded rows.  From documents, ``ordered_windows`` moves no token array.
    """
    order_cols = list(order_cols or [id_col])
    withn = encoded.withColumn("_nwin_", window_count(F.size(ids_col), max_seq_length, overlap_size))
    off = running_offsets(withn, order_cols, "_nwin_", "_start_")
    w = _explode_windows(off.drop("_nwin_"), ids_col, max_seq_length, overlap_size)
    return w.withColumn("sample_id", (F.col("_start_") + F.col("window_ix")).cast("bigint")).drop("_start_")


def ordered_windows(docs: DataFrame, tokenizer, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP,
                    text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """E1/E2 + E3 + E5: windows with ``sample_id`` in (id, window_ix) order, straight from documents.

    The texts are brought into order, then encoded where they lie: token arrays are written
    once and never shuffled.  ``tokenizer`` is any H1 plug-in.
    """
    enc = tokenizer.encode_df(in_order(docs.select(id_col, text_col), [id_col]), text_col, id_col)
    withn = enc.withColumn("_nwin_", window_count("n_tokens", max_seq_length, overlap_size))
    off = offsets_in_place(withn, "_nwin_", "_start_").drop("_nwin_")
    w = _explode_windows(off, "input_ids", max_seq_length, overlap_size)
    return w.withColumn("sample_id", (F.col("_start_") + F.col("window_ix")).cast("bigint")).drop("_start_")


def window_index(encoded: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH, overlap_size: int = OVERLAP,
                 id_col: str = "doc_id", order_cols=None) -> DataFrame:
    """E5: (doc_id, window_ix, n_tokens, sample_id) from token counts alone: no token array is moved or written."""
    order_cols = list(order_cols or [id_col])
    n = encoded.select(*dict.fromkeys([id_col, *order_cols]), F.col("n_tokens").alias("_n_"))
    off = running_offsets(n.withColumn("_nwin_", window_count("_n_", max_seq_length, overlap_size)), order_cols, "_nwin_", "_start_")
    w = off.where("_nwin_ > 0").withColumn("window_ix", F.explode(F.sequence(F.lit(0), (F.col("_nwin_") - 1).cast("int"))))
    left = F.col("_n_") - F.col("window_ix") * _stride(max_seq_length, overlap_size)
    return w.select(id_col, "window_ix", F.least(left, F.lit(max_seq_length)).cast("bigint").alias("n_tokens"),
                    (F.col("_start_") + F.col("window_ix")).cast("bigint").alias("sample_id"))


def sample_index(windows_df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """E5: dense global ``sample_id`` for an existing window table.

    Counts per document (ids only), running offsets over documents, then a
    join back on doc_id.  Prefer ``indexed_windows`` when starting from
    encoded documents: it avoids the join.
    """
    per_doc = windows_df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_nwin_"))
    off = running_offsets(per_doc, [id_col], "_nwin_", "_start_").drop("_nwin_")
    return (windows_df.join(off, id_col)
                      .withColumn("sample_id", (F.col("_start_") + F.col("window_ix")).cast("bigint"))
                      .drop("_start_"))


def batches(samples: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """batch_id = sample_id div batch_size, pos = sample_id % batch_size."""
    return (samples.withColumn("batch_id", F.expr(f"sample_id div {int(batch_size)}").cast("bigint"))
                   .withColumn("pos", F.pmod(F.col("sample_id"), F.lit(batch_size)).cast("int")))


def worker_shards(batched: DataFrame, num_workers: int = NUM_WORKERS) -> DataFrame:
    """Disjoint, complete loader shards by batch."""
    return batched.withColumn("shard", F.pmod(F.col("batch_id"), F.lit(num_workers)).cast("int"))


def collate(batched: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH, pad_id: int = tx.PAD_ID,
            ids_col: str = "input_ids") -> DataFrame:
    """Truncate to L, right-pad with pad_id to L; attention_mask by position."""
    m = F.least(F.size(ids_col), F.lit(max_seq_length))
    padn = F.lit(max_seq_length) - m
    return (batched.withColumn("attention_mask",
                               F.concat(F.array_repeat(F.lit(1), m), F.array_repeat(F.lit(0), padn)))
                   .withColumn(ids_col, F.concat(F.slice(ids_col, 1, max_seq_length),
                                                 F.array_repeat(F.lit(pad_id), padn))))


def lm_labels(collated: DataFrame, ignore_id: int = tx.IGNORE_ID, ids_col: str = "input_ids") -> DataFrame:
    """labels = ids where the mask is 1, ignore_id on padding (decided by position, not value).

    The mask is 1s then 0s, so the real length is the first 0's position;
    labels are two array slices, no per-element lambda.
    """
    first_pad = F.array_position(F.col("attention_mask"), 0)
    m = F.when(first_pad == 0, F.size("attention_mask")).otherwise(first_pad - 1).cast("int")
    return collated.withColumn("labels", F.concat(F.slice(F.col(ids_col), 1, m),
                                                  F.array_repeat(F.lit(ignore_id), F.size(ids_col) - m)))


def epochs(batch_index: DataFrame, num_epochs: int = NUM_EPOCHS) -> DataFrame:
    """The same order repeated per epoch (generated, not a join)."""
    return batch_index.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(num_epochs - 1))))


def accum_groups(batch_index: DataFrame, steps: int = ACCUM_STEPS) -> DataFrame:
    """Optimizer step of each micro-batch within its epoch."""
    return batch_index.withColumn("step", F.expr(f"batch_id div {int(steps)}").cast("bigint"))


def training_budget(encoded_with_split: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH,
                    overlap_size: int = OVERLAP, batch_size: int = BATCH_SIZE, accum: int = ACCUM_STEPS,
                    num_epochs: int = NUM_EPOCHS, log: int = LOG_INTERVAL, save: int = SAVE_INTERVAL,
                    val_cap: int = VAL_CAP, split_col: str = "split") -> DataFrame:
    """Samples, batches, optimizer steps, log/save events and validation batches per split."""
    c = sample_count(encoded_with_split, max_seq_length, overlap_size, by=[split_col])
    b = F.expr(f"(samples + {int(batch_size) - 1}) div {int(batch_size)}").cast("bigint")
    spe = F.expr(f"(batches + {int(accum) - 1}) div {int(accum)}").cast("bigint")
    log_every = max(1, log // accum)
    save_every = max(1, save // accum)
    return (c.withColumn("batches", b)
             .withColumn("steps_per_epoch", spe)
             .withColumn("total_steps", (F.col("steps_per_epoch") * num_epochs).cast("bigint"))
             .withColumn("log_events", F.expr(f"total_steps div {log_every}").cast("bigint"))
             .withColumn("save_events", F.expr(f"total_steps div {save_every}").cast("bigint"))
             .withColumn("eval_batches", F.when(F.col(split_col) == "validation",
                                                F.least(F.col("batches"), F.lit(val_cap)))
                                          .otherwise(F.lit(0)).cast("bigint")))


def padding_report(windows_df: DataFrame, max_seq_length: int = MAX_SEQ_LENGTH,
                   overlap_size: int = OVERLAP, by=()) -> DataFrame:
    """Real vs padded tokens, tokens repeated by the overlap, full vs short windows."""
    n = F.col("n_tokens")
    return (windows_df.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("windows"),
        F.sum(n).cast("bigint").alias("real_tokens"),
        F.sum(F.lit(max_seq_length) - n).cast("bigint").alias("pad_tokens"),
        F.sum(F.when(F.col("window_ix") > 0, F.least(n, F.lit(overlap_size))).otherwise(0))
         .cast("bigint").alias("overlap_tokens"),
        F.sum(F.when(n == max_seq_length, 1).otherwise(0)).cast("bigint").alias("full_windows"),
        F.sum(F.when(n < max_seq_length, 1).otherwise(0)).cast("bigint").alias("short_windows")))


def window_histogram(windows_df: DataFrame, width: int = 64) -> DataFrame:
    """Windows and their tokens by length, in steps of ``width`` tokens."""
    at = F.expr(f"n_tokens div {int(width)} * {int(width)}").cast("bigint")
    return windows_df.groupBy(at.alias("from_tokens")).agg(F.count(F.lit(1)).cast("bigint").alias("windows"), F.sum("n_tokens").cast("bigint").alias("tokens"))


# --- H2: collate plug-in -------------------------------------------------------

def collate_with(batched: DataFrame, collate_fn=None, **kwargs) -> DataFrame:
    """H2: a user collate function bound with keyword arguments (``functools.partial`` style).

    ``collate_fn(df, **kwargs) -> DataFrame`` runs as ``DataFrame.transform``;
    the default is ``collate`` (right padding to L with the pad id).
    """
    return batched.transform(collate_fn or collate, **kwargs)


def collate_arrow(batched: DataFrame, fn, schema) -> DataFrame:
    """H2, Arrow form: ``fn(iterator of pyarrow.RecordBatch) -> iterator of RecordBatch`` per partition."""
    return batched.mapInArrow(fn, schema)
