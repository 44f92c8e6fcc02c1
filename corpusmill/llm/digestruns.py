"""Exact duplicates by a tree merge of sorted digest runs, DataFrame operations only.

Every input partition gives a run: one entry (digest, verification, best row,
number of rows) per document.  Runs are merged in binomial rounds.  A run lives at an
address, at first the number of its input partition; in a round the partners
whose addresses differ in the same few bits exchange entries, each entry
going to the partner whose bits are its digest's.  What arrives is merged
by a sort on the digest and one pass that puts equal neighbours together, after the
verification (byte length and a second, independent hash) agrees as well,
and keeps the best identifier.  After the last round the address is the
digest's prefix: all entries of a digest have met.

A task never receives more than ``fan_in`` runs, and a text that a third of
all rows share is one entry per run after the first round, whatever the input's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import fresh, matching, saved

FAN_IN_BITS = 3              # a round merges up to 2**3 partners
HOT_GROUPS = 100_000         # groups with more than 1/HOT_GROUPS of the rows: there are fewer of them than this
KEY = ["digest", "n_bytes", "second"]


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """(doc_id, digest, n_bytes, second, place, run, row), a row per row of ``docs``, written."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    sha = F.sha2(text, 256)
    return saved(docs.select(F.col(id_col).alias("doc_id"), sha.alias("sha"), F.octet_length(text).alias("n_bytes"),
                             F.xxhash64(text).alias("second")).select(
        "doc_id", F.unhex("sha").alias("digest"), "n_bytes", "second",
        F.conv(F.substring("sha", 1, 7), 16, 10).cast("int").alias("place"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row")), "runs-entries")


def merged(rows: DataFrame, keep: str = "smallest", fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """(digest, n_bytes, second, best, n): the runs of ``rows`` merged into one entry per text.

    ``best`` is (doc_id, row) of the row with the smallest or largest doc_id; a null
    doc_id is best only where all are null.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    bits = min(max(1, (runs - 1).bit_length()), 28)
    best = F.max if keep == "largest" else F.min
    # The smallest of (is null, doc_id, row), or the largest of (is known, doc_id, row): a known identifier wins.
    known = F.col("doc_id").isNotNull()
    first = F.struct((known if keep == "largest" else ~known).alias("flag"), "doc_id", "row")
    level = rows.select(*KEY, "place", F.pmod("run", F.lit(1 << bits)).alias("home"), first.alias("best"), F.lit(1).cast("bigint").alias("n"))
    for low in range(0, bits, fan_in_bits):
        mask = ((1 << min(fan_in_bits, bits - low)) - 1) << low
        home = F.col("home").bitwiseAND(F.lit(~mask)).bitwiseOR(F.col("place").bitwiseAND(F.lit(mask)))
        level = (level.withColumn("home", home).repartitionById(1 << bits, "home")
                      .groupBy("home", *KEY, "place").agg(best("best").alias("best"), F.sum("n").alias("n")))
    return saved(level.select(*KEY, F.struct("best.doc_id", "best.row").alias("best"), "n"), "runs-merged")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 normalise=None, fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when they are identical after ``normalise`` (a function of a Column; by
    default none).  Null text is empty text.  Exactly one row of each group is
    kept: one with the smallest (or largest) doc_id; where several rows share that id, the one
    that the scan numbers first (or last), its equals in this result.  A null doc_id is kept only
    where the whole group has none.  An empty table gives an empty result;
    other columns are not read.
    """
    rows = entries(docs, id_col, text_col, normalise)
    groups = merged(rows, keep, fan_in_bits).where("n > 1")
    total = rows.count()
    # Fewer than HOT_GROUPS groups can have more than 1/HOT_GROUPS of the rows: a broadcast of bounded size.
    # What is left to the shuffled join has no hot key.
    hot = groups.where(F.col("n") * HOT_GROUPS > total)
    rest = groups.where(F.col("n") * HOT_GROUPS <= total)
    out = rows.join(F.broadcast(hot), KEY).unionByName(
        rows.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(rest.hint("merge"), KEY, "left"))
    single = F.col("n").isNull()
    return out.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
                      (single | (F.col("row") == F.col("best.row"))).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None, **kw) -> DataFrame:
    """The kept rows of ``docs``, columns unchanged.

    Rows go by (id, digest); of rows that repeat both, one stays if their group keeps that id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    i, d = fresh(docs, "cm_id", "cm_digest")
    pairs = saved(exact_groups(docs, id_col, text_col, normalise=normalise, **kw)
                  .groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("kept").cast("int")).alias("kept"))
                  .where("rows > kept").select(F.col("doc_id").alias(i), F.col("text_sha256").alias(d), "kept"), "runs-pairs")
    keyed = docs.withColumn(d, F.sha2(normalise(text) if normalise else text, 256))

    def on(keys):
        return keyed[id_col].eqNullSafe(keys[i]) & (keyed[d] == keys[d])
    once = pairs.where("kept > 0").select(i, d)
    left = matching(keyed, pairs.select(i, d), on(pairs), "left_anti")
    again = matching(keyed, once, on(once), "left_semi").dropDuplicates([id_col, d])
    return left.unionAll(again).select(*docs.columns)
