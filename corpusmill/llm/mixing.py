"""Mixing sources to target weights by entropy balancing, DataFrame operations only.

Targets come from water filling: sources share a number of words by weight,
none above a multiple of its own size.  Rates come from entropy balancing:
per source, the rates nearest to one (least relative entropy, a document
weighing its own size plus its source's mean size) whose words add up to the
target.  The convex dual has one multiplier per source; the rate
of a document is the exponential tilt ``exp(lam * size / (size + mean))``, at most
``max_copies``.  Newton steps run for all sources at once on the histogram
(source, size, documents), which is all that the dual depends on.  Rates are
rounded to whole copies, largest documents first, each taking up the words
that those before it were over or under.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import WORD_RE, fresh, matching, null_safe, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
BUCKET_ROWS = 512
PART_ROWS = 65_536           # rows that are numbered together


def word_count(text_col: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def source_targets(units: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n_docs, target) from ``units(source, size, k)``.

    Sources are numbered in code-point order, null last, through ranges (no
    task holds them all); water filling adds one round per set of sources
    that reach their cap, on this table of one row per source.
    """
    sums = saved(units.groupBy("source").agg(F.sum(F.col("size") * F.col("k")).alias("source_size"),
                                             F.sum("k").alias("n_docs")), "mix-sources")
    ranged = saved(sums.repartitionByRange(F.col("source").isNull().cast("int"), "source")
                       .withColumn("part", F.spark_partition_id()), "mix-ranged")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    pos = ranged.join(before, "part").withColumn(
        "i", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    src = saved(pos.select("source", "source_size", "n_docs", weight.alias("w"),
                           (F.col("source_size") * max_copies).cast("double").alias("cap")), "mix-weights")
    words = src.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:                                    # ends: the set of full sources only grows
        at_cap = F.col("w") * F.lit(level) >= F.col("cap") if full >= 0 else F.lit(False)
        a = src.agg(F.sum(F.when(at_cap, F.col("cap")).otherwise(0.0)).alias("used"),
                    F.sum(F.when(at_cap, 0.0).otherwise(F.col("w"))).alias("open"),
                    F.sum(at_cap.cast("int")).alias("n")).first()
        if not a["open"] or a["n"] == full:
            break
        full, level = a["n"], (share * words - a["used"]) / a["open"]
    target = F.least(F.col("cap"), F.col("w") * F.lit(level)) if words else F.lit(0.0)
    return src.select("source", "source_size", "n_docs", target.alias("target"))


def tilts(units: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES, tolerance: float = 1e-9) -> DataFrame:
    """(source keys, lam) solving sum(k * size * min(max_copies, exp(lam * z))) = target for every source.

    z = size / (size + mean).  Newton's method on a non-decreasing function,
    kept inside a bracket that halves whenever a step leaves it; all
    sources step together and the loop ends when all residuals are within
    ``tolerance`` of their target (or brackets have shrunk to nothing).
    Sources without words, or whose target is all they may give, need no multiplier.
    """
    top = math.log(max_copies)
    t = null_safe(targets, "source", "s").where("source_size > 0").select(
        "s_k", "s_n", "target", (F.col("source_size") / F.col("n_docs")).alias("mean"),
        (F.col("target") >= F.col("source_size") * max_copies).alias("all_in"))
    hist = null_safe(units.where("size > 0"), "source", "s").groupBy("s_k", "s_n", "size").agg(F.sum("k").alias("k"))
    hist = saved(hist.join(saved(t, "mix-t"), ["s_k", "s_n"]).where(~F.col("all_in"))
                     .select("s_k", "s_n", (F.col("size") * F.col("k")).cast("double").alias("words"), "target", "mean",
                             (F.col("size") / (F.col("size") + F.col("mean"))).alias("z")), "mix-hist")
    # At lam = hi every document is at its cap; at lam = lo every document of a word or more gives (almost) nothing.
    state = saved(hist.groupBy("s_k", "s_n").agg(F.first("target").alias("target"), F.min("z").alias("zmin"),
                                                       F.log(F.first("target") / F.sum("words")).alias("want"), (F.sum(F.col("words") * F.col("z")) / F.sum("words")).alias("zbar")).select(
        "s_k", "s_n", "target", (F.col("want") / F.col("zbar")).alias("lam"), (F.lit(-40.0) / F.col("zmin")).alias("lo"),
        (F.lit(top + 1e-9) / F.col("zmin")).alias("hi"), F.lit(False).alias("done")), "mix-state")
    while True:
        e = F.exp(F.least(F.col("lam") * F.col("z"), F.lit(top)))
        free = F.col("lam") * F.col("z") < top
        f = (hist.select("s_k", "s_n", "words", "z").join(state.where(~F.col("done")), ["s_k", "s_n"])
                 .groupBy("s_k", "s_n").agg(F.sum(F.col("words") * e).alias("g"),
                                            F.sum(F.when(free, F.col("words") * F.col("z") * e).otherwise(0.0)).alias("slope")))
        miss = F.col("g") - F.col("target")
        lo = F.when(miss < 0, F.greatest("lam", "lo")).otherwise(F.col("lo"))
        hi = F.when(miss >= 0, F.least("lam", "hi")).otherwise(F.col("hi"))
        step = F.when(F.col("slope") > 0, F.col("lam") - miss / F.col("slope"))
        safe = F.when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
        ended = (F.abs(miss) <= tolerance * F.col("target")) | (hi - lo <= F.lit(1e-13) * (F.abs(lo) + F.abs(hi)))
        new = state.join(f, ["s_k", "s_n"], "left").select(
            "s_k", "s_n", "target",
            F.when(F.col("g").isNull() | ended, F.col("lam")).otherwise(safe).alias("lam"),
            F.when(F.col("g").isNull(), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("g").isNull(), F.col("hi")).otherwise(hi).alias("hi"),
            F.coalesce(F.col("done") | ended, F.lit(True)).alias("done"))
        state = saved(new, "mix-state")
        if state.where(~F.col("done")).limit(1).count() == 0:
            # Nine decimals: the order in which tasks' sums meet must not show in the copies.
            return state.select("s_k", "s_n", F.round("lam", 9).alias("lam"))


def dealt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, more, k) per distinct (doc_id, source, size).

    Of the ``k`` rows that share these three values ``more`` are taken ``copies + 1`` times, the others ``copies`` times.
    """
    units = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"))
                      .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("k")), "mix-units")
    targets = saved(source_targets(units, weights, share, max_copies), "mix-targets")
    lam = tilts(units, targets, max_copies)
    per_source = saved(null_safe(targets, "source", "s").join(lam, ["s_k", "s_n"], "left")
                       .select("s_k", "s_n", "source_size", "n_docs", "target", "lam"), "mix-per-source")
    z = F.col("size") / (F.col("size") + F.col("source_size") / F.col("n_docs"))
    rate = (F.when(F.col("size") == 0, F.lit(0.0))
             .when(F.col("lam").isNull(), F.lit(float(max_copies)))
             .otherwise(F.least(F.exp(F.least(F.col("lam") * z, F.lit(math.log(max_copies)))), F.lit(float(max_copies)))))
    h = F.xxhash64("doc_id", "size")
    rows = (null_safe(units, "source", "s").join(per_source, ["s_k", "s_n"])
            .withColumn("rate", rate).withColumn("h", h)
            .withColumn("bucket", F.pmod(F.xxhash64(F.col("h"), F.lit(7)), F.ceil(F.col("n_docs") / bucket_rows))))
    item = F.struct((-F.col("size")).alias("down"), "h", "doc_id", "size", "rate", "k")
    grouped = rows.groupBy("s_k", "s_n", "bucket", "source", "source_size", "target").agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    zero = F.struct(F.lit(0.0).alias("over"), F.array().cast("array<bigint>").alias("copies"))

    def place(state, x):
        """Copies of a unit's rows together, given the words that those before were over or under."""
        size = F.greatest(x["size"], F.lit(1))
        want = F.least(F.greatest(F.round((x["rate"] * x["k"] * size + state["over"]) / size), F.lit(0.0)), x["k"] * float(max_copies))
        copies = F.when(x["size"] == 0, F.lit(0.0)).otherwise(want)
        over = F.when(x["size"] == 0, state["over"]).otherwise(state["over"] + (x["rate"] * x["k"] - copies) * size)
        return F.struct(over.alias("over"), F.concat(state["copies"], F.array(copies.cast("bigint"))).alias("copies"))
    out = grouped.select("source", "source_size", "target", "items", F.aggregate("items", zero, place)["copies"].alias("n")) \
        .select("source", "source_size", "target", F.inline(F.arrays_zip("items", "n")))
    k = F.col("items.k")
    return out.select("items.doc_id", "source", "items.size", "source_size", "target", "items.rate",
                      F.floor((F.col("n") - F.col("n") % k) / k).cast("int").alias("copies"), (F.col("n") % k).alias("more"), k.alias("k"))


def mix(docs: DataFrame, *args, **kw) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken, k) per distinct (doc_id, source, size) and number of copies.

    ``k`` counts the rows that share these values; each of them is taken
    ``copies`` times (0 to ``max_copies``).  taken = copies * size.  Rows that share id,
    source and size may differ by one copy, so that they give together what one row each would.  The rounding
    works in buckets of about ``bucket_rows`` documents of one source, dealt by
    a hash of the id, so a source with a third of all rows is spread over many
    tasks; a bucket ends within half of its smallest documents of its share.
    Null text has size 0 and takes nothing; a null source is one source, last
    in order; null and repeated ids are documents like others; an empty table
    gives an empty result; other columns are not read.
    """
    kinds = F.filter(F.array(F.struct((F.col("copies") + 1).alias("copies"), F.col("more").alias("k")),
                             F.struct("copies", (F.col("k") - F.col("more")).alias("k"))), lambda x: x["k"] > 0)
    out = dealt(docs, *args, **kw).withColumn("kind", F.explode(kinds))
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "kind.copies",
                      (F.col("size") * F.col("kind.copies")).alias("taken"), "kind.k")


def mix_rows(mixed: DataFrame) -> DataFrame:
    """One row per input row: (doc_id, size, source_size, target, taken, copies, rate)."""
    return mixed.withColumn("one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("k")))).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it is taken, its columns unchanged."""
    names = ("id", "source", "size", "copies", "more", "k", "unit", "hash", "rows", "quota", "part", "before", "copy")
    i, src, n, c, more, k, unit, h, rows, quota, part, before, copy = fresh(docs, *[f"cm_{x}" for x in names])
    m = saved(dealt(docs, id_col, text_col, source_col, **kw).where("copies > 0 or more > 0").select(
        F.col("doc_id").alias(i), F.col("source").alias(src), F.col("size").alias(n), F.col("copies").alias(c), F.col("more").alias(more),
        F.col("k").alias(k), F.monotonically_increasing_id().alias(unit)), "mix-copies")
    on = docs[id_col].eqNullSafe(m[i]) & docs[source_col].cast("string").eqNullSafe(m[src]) & (word_count(text_col) == m[n])

    def copied(df):
        return df.where(F.col(c) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*docs.columns)
    # A sort-merge join at every size: there is a row of copies for nearly every document.
    out = copied(docs.join(m.where(F.col(more) == 0).hint("merge"), on))
    if m.where(F.col(more) > 0).limit(1).count() == 0:
        return out

    def running(df, keys, value, order):
        """The sum of ``value`` over the rows of the same keys before each, parts first: no task sorts a whole unit."""
        sums = df.groupBy(*keys, part).agg(F.sum(value).alias(before))
        start = sums.withColumn(before, F.coalesce(F.sum(before).over(
            Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        inside = F.coalesce(F.sum(value).over(Window.partitionBy(*keys, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return df.withColumn(copy, inside).join(start, [*keys, part]).withColumn(before, F.col(before) + F.col(copy)).drop(copy, part)
    # Units whose rows differ: rows in the order of a hash over all their columns take the copy more, and the last
    # of them, equal in every column, for some of its repeats - which of those does not show.
    hashable = [c for c, t in docs.dtypes if "map<" not in t and t != "variant"]
    split = docs.join(m.where(F.col(more) > 0).hint("merge"), on).withColumn(h, F.xxhash64(*hashable))
    texts = saved(split.groupBy(unit, more, k, h).agg(F.count(F.lit(1)).alias(rows))
                       .withColumn(part, F.pmod(h, F.ceil(F.col(k) / PART_ROWS))), "mix-texts")
    due = F.greatest(F.lit(0), F.least(F.col(rows), F.col(more) - F.col(before)))
    due = saved(running(texts, [unit], F.col(rows), h).select(unit, h, rows, due.alias(quota)), "mix-quotas")
    split = matching(split, due, [unit, h], "inner", 200_000)
    some = (F.col(quota) > 0) & (F.col(quota) < F.col(rows))
    sure = split.where(~some).withColumn(c, F.col(c) + (F.col(quota) > 0).cast("int"))
    edge = saved(split.where(some).withColumn(part, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col(rows) / PART_ROWS))), "mix-edge")
    edge = running(edge, [unit, h], F.lit(1), h).withColumn(c, F.col(c) + (F.col(before) < F.col(quota)).cast("int"))
    return out.unionByName(copied(sure)).unionByName(copied(edge))
