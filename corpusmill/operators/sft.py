"""Instruction-tuning (SFT) records: pairs, filtering, prompt template, encoding, batches, report.

Turns are paired by their order, not by their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import windows as W
from corpusmill.operators.joins import checked_join, materialize
from corpusmill.operators.prefix import in_order, offsets_in_place

# The public Alpaca prompt template (with-input and no-input forms).
PROMPT_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n")
PROMPT_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Response:\n")

KEY = ["conv_id", "turn"]


TURN_RANGE = 4096           # turns of a conversation that one task puts in order


def next_turns(conversations: DataFrame) -> DataFrame:
    """Every turn with the role and text of the one after it, whatever the numbers between.

    Conversations are ordered in ranges of turn numbers, and the first turn of each range is
    handed to the last of the range before, so a very long conversation is spread over many tasks.
    """
    c = conversations.select("conv_id", "turn", "role", "text").withColumn("_r_", F.floor(F.col("turn") / TURN_RANGE))
    order = Window.partitionBy("conv_id", "_r_").orderBy("turn", "role", "text")
    nxt = F.lead(F.struct("role", "text")).over(order)
    inside = c.withColumn("_next_", nxt)
    first = c.groupBy("conv_id", "_r_").agg(F.min(F.struct("turn", "role", "text")).alias("_f_"))
    after = materialize(first.select("conv_id", "_r_", F.lead("_f_").over(Window.partitionBy("conv_id").orderBy("_r_")).alias("_f_"))
                             .where(F.col("_f_").isNotNull()))
    ends = checked_join(inside, after, ["conv_id", "_r_"], "left")
    return ends.select("conv_id", "turn", "role", "text",
                       F.coalesce(F.col("_next_.role"), F.when(F.col("_next_").isNull(), F.col("_f_.role"))).alias("next_role"),
                       F.when(F.col("_next_").isNull(), F.col("_f_.text")).otherwise(F.col("_next_.text")).alias("next_text"))


def sft_pairs(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, instruction, input, output) from user turns that an assistant turn follows.

    ``input`` is the conversation's system turn when it sits at turn 0, else ''.
    """
    pairs = next_turns(conversations).where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("instruction"), F.col("next_text").alias("output"))
    system = conversations.where((F.col("role") == "system") & (F.col("turn") == 0)) \
                          .select("conv_id", F.col("text").alias("input"))
    return (checked_join(pairs, system, "conv_id", "left")
            .select("conv_id", "turn", "instruction", F.coalesce("input", F.lit("")).alias("input"), "output"))


def sft_filter(records: DataFrame) -> DataFrame:
    """drop empty instruction/output; keep one record per exact (instruction, input, output).

    The survivor is the smallest (conv_id, turn).  The key hashes the texts with their
    lengths, so no two records share it by where one text ends; texts are not
    aggregated: the survivors' ids are, and pick the rows.
    """
    nonempty = records.where((F.trim("instruction") != "") & (F.trim("output") != ""))
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("instruction", "input", "output")]
    sizes = [F.concat(F.octet_length(p).cast("string"), F.lit(":")) for p in parts]
    keyed = nonempty.withColumn("_k_", F.sha2(F.concat(*sizes, *parts), 256))
    first = materialize(keyed.groupBy("_k_").agg(F.min(F.struct(*KEY)).alias("_id_")).select("_k_", "_id_.*"))
    return keyed.join(first, ["_k_", *KEY], "left_semi").drop("_k_").select(*records.columns)


def sft_prompt(records: DataFrame) -> DataFrame:
    """render the Alpaca template (with-input form when input is non-empty)."""
    def fill(tpl, with_input):
        a, rest = tpl.split("{instruction}")
        parts = [F.lit(a), F.col("instruction")]
        if with_input:
            b, c = rest.split("{input}")
            parts += [F.lit(b), F.col("input"), F.lit(c)]
        else:
            parts += [F.lit(rest)]
        return F.concat(*parts)
    has_input = F.coalesce(F.col("input"), F.lit("")) != ""
    return records.withColumn("prompt", F.when(has_input, fill(PROMPT_WITH_INPUT, True))
                                         .otherwise(fill(PROMPT_NO_INPUT, False)))


def sft_encode(records: DataFrame, tokenizer, max_seq_length: int = W.MAX_SEQ_LENGTH,
               eos_id: int = tx.EOS_ID, ignore_id: int = tx.IGNORE_ID) -> DataFrame:
    """ids = enc(prompt) ++ enc(output) ++ [eos]; labels ignore the prompt; cut to L.

    Records whose prompt alone fills the window (no response token left) are dropped.
    ``tokenizer`` is any H1 plug-in: prompt and output are encoded in one pass, after the texts
    have been brought into the order of (conv_id, turn), so token arrays are not joined and need not move again.
    """
    j = tokenizer.encode_columns(in_order(records.select(*KEY, "prompt", "output"), KEY), {"prompt": "p_ids", "output": "o_ids"})
    resp = F.concat(F.col("o_ids"), F.array(F.lit(eos_id)))
    ids = F.concat(F.col("p_ids"), resp)
    labels = F.concat(F.array_repeat(F.lit(ignore_id), F.size("p_ids")), resp)
    out = j.select(*KEY, F.size("p_ids").cast("bigint").alias("prompt_tokens"),
                   (F.size("o_ids") + 1).cast("bigint").alias("response_tokens"),
                   F.slice(ids, 1, max_seq_length).alias("input_ids"),
                   F.slice(labels, 1, max_seq_length).alias("labels"))
    return out.where(F.col("prompt_tokens") < max_seq_length) \
              .withColumn("n_tokens", F.size("input_ids").cast("bigint"))


def sft_batches(encoded: DataFrame, batch_size: int = W.BATCH_SIZE, max_seq_length: int = W.MAX_SEQ_LENGTH,
                pad_id: int = tx.PAD_ID, ignore_id: int = tx.IGNORE_ID) -> DataFrame:
    """dense sample_id in (conv_id, turn) order, batches, right padding, mask and padded labels.

    ``encoded`` as ``sft_encode`` leaves it, in that order.
    """
    idx = offsets_in_place(encoded.withColumn("_one_", F.lit(1)), "_one_", "sample_id").drop("_one_")
    b = W.collate(W.batches(idx, batch_size), max_seq_length, pad_id)
    padn = F.lit(max_seq_length) - F.size("labels")
    return b.withColumn("labels", F.concat("labels", F.array_repeat(F.lit(ignore_id), padn)))


def hist_percentiles(df: DataFrame, col: str, ps) -> DataFrame:
    """(metric, value): exact interpolated percentiles (as percentile_cont) of an integer column.

    Counts per distinct value first (map-side partial aggregation), so the only
    single-task step works on the histogram, whose size is the number of
    distinct values - never on the rows.
    """
    h = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    h = h.select("v", "c", F.sum("c").over(w).alias("cum"), F.sum("c").over(Window.partitionBy()).alias("N"))
    aggs = []
    for p in ps:
        x = F.lit(float(p)) * (F.col("N") - 1).cast("double")
        lo, hi = F.floor(x), F.ceil(x)
        at_lo = F.min(F.when(F.col("cum") > lo, F.col("v")))
        at_hi = F.min(F.when(F.col("cum") > hi, F.col("v")))
        frac = F.first(x - lo)
        aggs.append(F.struct(F.lit(f"{col}_p{int(round(p * 100))}").alias("metric"),
                             tx.round6(at_lo + frac * (at_hi - at_lo)).alias("value")))
    return h.agg(F.array(*aggs).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def sft_report(encoded: DataFrame, max_seq_length: int = W.MAX_SEQ_LENGTH) -> DataFrame:
    """(metric, value) rows: records, conversations, truncated count/share, token percentiles."""
    full = F.col("prompt_tokens") + F.col("response_tokens")
    base = encoded.agg(F.count(F.lit(1)).alias("records"),
                       F.countDistinct("conv_id").alias("conversations"), F.countDistinct("conv_id", "turn").alias("turns"),
                       F.sum(F.when(full > max_seq_length, 1).otherwise(0)).alias("truncated"))
    base = base.select(F.explode(F.array(
        *[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
          for k in ("records", "conversations", "turns", "truncated")],
        F.struct(F.lit("truncated_share").alias("metric"),
                 tx.safe_ratio("truncated", "records").alias("value")))).alias("m")).select("m.*")
    pp = hist_percentiles(encoded, "prompt_tokens", (0.5, 0.9))
    rp = hist_percentiles(encoded, "response_tokens", (0.5, 0.9))
    return base.unionByName(pp).unionByName(rp)
