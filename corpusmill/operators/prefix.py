"""Global order statistics without a global window.

``Window.orderBy`` with no ``partitionBy`` pulls every row into one task.
Both helpers here split the order into ranges, aggregate per range (a
small table: ranges x groups), prefix-sum those totals, and only then run
windows inside single ranges.

* ``prefix_cutoff`` - keep the rows of each group whose running weight, in
  (key, tie) order, stays within a budget.  Because the kept set is a
  prefix, only the one range per group that straddles the budget is ever
  ranked row by row; everything else is decided from range totals and a
  final filter (no join of the rows against the result).
* ``running_offsets`` - the exclusive running sum of a weight in a global
  order, for every row (dense global indexes).
* ``in_order`` and ``offsets_in_place`` - the same for rows that are brought
  into order before something wide is made of them: the running sum is
  taken where the rows are, nothing moves afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.joins import checked_join, materialize, stored

_G = "_grp_"


def _range_of(key_col: str, ranges_log2: int, key_bits: int) -> "F.Column":
    return F.shiftright(F.col(key_col), key_bits - ranges_log2).cast("int")


def prefix_cutoff(df: DataFrame, group_cols, key_col: str, tie_col: str, weight_col: str | None,
                  budget, ranges_log2: int = 12, key_bits: int = 32) -> DataFrame:
    """Rows whose cumulative weight within their group, in (key, tie) order, is <= budget.

    ``key_col`` must be a non-negative integer < 2**key_bits spread evenly
    (a hash bucket).  ``budget`` is a number, or a function
    ``(rows_col, weight_col) -> Column`` of the group's totals.
    """
    group_cols = list(group_cols)
    # One struct as the key: never null itself, so rows whose group columns are null make up groups like others.
    base = df.withColumn(_G, F.struct(*group_cols) if group_cols else F.lit(0))
    gcols = [_G]
    w = F.col(weight_col).cast("bigint") if weight_col else F.lit(1).cast("bigint")
    cells = (base.select(*gcols, _range_of(key_col, ranges_log2, key_bits).alias("_r_"), w.alias("_w_"))
                 .groupBy(*gcols, "_r_").agg(F.sum("_w_").alias("cw"), F.count(F.lit(1)).alias("cn")))
    gw = Window.partitionBy(*gcols)
    ordw = gw.orderBy("_r_").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*gcols, "_r_", "cw",
                         F.coalesce(F.sum("cw").over(ordw), F.lit(0)).alias("before"),
                         F.sum("cw").over(gw).alias("g_w"), F.sum("cn").over(gw).alias("g_n"))
    if callable(budget):
        cells = cells.withColumn("_budget_", budget(F.col("g_n"), F.col("g_w")).cast("bigint"))
    else:
        cells = cells.withColumn("_budget_", F.lit(int(budget)).cast("bigint"))
    cells = materialize(cells)
    # The single range per group where the running total crosses the budget.
    straddle = cells.where((F.col("before") <= F.col("_budget_")) &
                           (F.col("before") + F.col("cw") > F.col("_budget_")))
    rows = base.withColumn("_r_", _range_of(key_col, ranges_log2, key_bits)).withColumn("_w_", w)
    inner = (checked_join(rows, straddle.select(*gcols, "_r_", "before", "_budget_"), gcols + ["_r_"])
                 .withColumn("_cum_", F.col("before") + F.sum("_w_").over(
                     Window.partitionBy(*gcols, "_r_").orderBy(key_col, tie_col)
                           .rowsBetween(Window.unboundedPreceding, 0)))
                 .where(F.col("_cum_") <= F.col("_budget_"))
                 .groupBy(*gcols).agg(F.max(F.struct(key_col, tie_col)).alias("_last_")))
    # Per group: a full-range bound (all ranges < r_full are kept) and an exact (key, tie) bound.
    full = (cells.where(F.col("before") + F.col("cw") <= F.col("_budget_"))
                 .groupBy(*gcols).agg(F.max("_r_").alias("_rfull_")))
    bounds = materialize(cells.select(*gcols).distinct().join(full, gcols, "left").join(inner, gcols, "left"))
    kept = checked_join(rows, bounds, gcols, small_rows=bounds.count())
    r = F.col("_r_")
    k, t = F.col(key_col), F.col(tie_col)
    lk, lt = F.col("_last_")[key_col], F.col("_last_")[tie_col]
    cond = (F.coalesce(r <= F.col("_rfull_"), F.lit(False)) |
            F.coalesce((k < lk) | ((k == lk) & (t <= lt)), F.lit(False)))
    out = kept.where(cond).drop("_r_", "_w_", "_rfull_", "_last_")
    return out.drop(_G)


def running_offsets(df: DataFrame, order_cols, weight_col: str, out_col: str = "offset",
                    num_ranges: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over all rows strictly before this one.

    Range-partition on the order (boundaries sampled by Spark's range
    partitioner), total each range, prefix-sum the range totals (one row per
    range), then a window inside each range adds the local running sum.
    """
    order_cols = list(order_cols)
    spark = df.sparkSession
    n = num_ranges or max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_pid_", F.spark_partition_id()))
    totals = ranged.groupBy("_pid_").agg(F.sum(weight_col).cast("bigint").alias("_t_"))
    offs = totals.select("_pid_", F.coalesce(F.sum("_t_").over(
        Window.orderBy("_pid_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base_"))
    local = F.sum(weight_col).over(Window.partitionBy("_pid_").orderBy(*order_cols)
                                   .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.join(F.broadcast(offs), "_pid_")
                  .withColumn(out_col, (F.col("_base_") + F.coalesce(local, F.lit(0))).cast("bigint"))
                  .drop("_pid_", "_base_"))


def in_order(df: DataFrame, order_cols) -> DataFrame:
    """Rows in the global order: a range of it per partition, sorted inside."""
    return df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)


def offsets_in_place(df: DataFrame, weight_col: str, out_col: str = "offset") -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over all rows before this one; ``df`` made from ``in_order`` rows by narrow steps.

    Each task adds up its range as the rows pass (only the weights go
    through Python), the result is written once, and the ranges' own starts - a row per range - are
    broadcast.  The rows are not moved.
    """
    @F.pandas_udf("bigint")
    def before(weights: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = 0
        for w in weights:
            upto = w.cumsum() + total
            yield upto - w
            total = int(upto.iloc[-1]) if len(upto) else total
    rows = stored(df.withColumn("_part_", F.spark_partition_id())
                    .withColumn("_before_", before.asNondeterministic()(F.col(weight_col).cast("bigint"))), "in-place")
    totals = rows.groupBy("_part_").agg(F.sum(weight_col).cast("bigint").alias("_t_"))
    starts = totals.select("_part_", F.coalesce(F.sum("_t_").over(
        Window.orderBy("_part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base_"))
    return (rows.join(F.broadcast(stored(starts, "in-place-starts")), "_part_")
                .withColumn(out_col, (F.col("_base_") + F.col("_before_")).cast("bigint")).drop("_part_", "_base_", "_before_"))
