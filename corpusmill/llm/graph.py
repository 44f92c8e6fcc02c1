"""Connected components by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import saved


def _flatten(parent: DataFrame, name: str) -> DataFrame:
    """Point every (v, p) at the root of its tree by pointer doubling."""
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        new = saved(parent.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")),
                    name)
        parent = new.select("v", "p")
        if new.where("moved").limit(1).count() == 0:
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges(a, b)``; root is the smallest vertex of its component.

    Every vertex hooks onto its smallest neighbour (or itself), the trees are
    flattened by pointer doubling, and the edges that still run between two
    trees form the smaller graph of the next round.  Each round at least
    halves the vertices that still have edges, so the loop ends by itself:
    there is no round limit.  Aggregations combine before they shuffle (a star
    with a third of all vertices costs one row per task), and each joined
    table is a written one, so AQE can split a hot join key.

    Null ends, self-links and repeated edges are ignored.
    """
    e = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a < b").distinct(), "cc-edges")
    labels = None
    while e.limit(1).count():
        ends = e.select(F.col("b").alias("v"), F.col("a").alias("p")).unionAll(e.select(F.col("a").alias("v"), F.col("a").alias("p")))
        parent = saved(ends.groupBy("v").agg(F.min("p").alias("p")), "cc-parent")
        parent = _flatten(parent, "cc-flat")
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            labels = saved(labels.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p")), "cc-labels")
        ra = parent.select(F.col("v").alias("a"), F.col("p").alias("ra"))
        rb = parent.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        e = saved(e.join(ra, "a").join(rb, "b").where("ra <> rb")
                   .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return e.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return labels.select("v", F.col("p").alias("root"))
