"""Merkle manifest of a dataset by slot pivots, DataFrame operations only.

Leaves are digests of rows.  A level is built by one grouped aggregation:
conditional aggregates spread the children of each parent into ``fanout`` slot
columns, and the digest of the concatenated columns is the parent.  The same
columns without a child's own slot are that child's siblings, so proofs are
read off the pivoted levels from the top down.  Every group (source) has a
tree of its own; the subroots, in the order of the groups, are the leaves of
the tree above them.

Places in a group come from a range partitioning: a running number inside
each sorted partition and one row per (group, partition) with what lies
before, so a group with a third of all rows is spread like the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import matching, null_safe, saved

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in (group, order) with (part, at), and (group, part, first, before) to tell places in the group.

    Ascending, null first.  place = before + at - first.
    """
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    number = F.monotonically_increasing_id()
    ranged = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("at", number).withColumn("part", F.shiftright("at", 33)), "merkle-ranged")
    spans = ranged.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return ranged, saved(spans.withColumn("before", F.coalesce(before, F.lit(0))), "merkle-spans")


def numbered(groups: DataFrame, group: str) -> DataFrame:
    """``groups`` with ``gid``: the place of the group among all, null first; no task holds all groups."""
    ranged, spans = placed(groups.withColumn("all", F.lit(0)), "all", [group])
    return saved(matching(ranged, spans.drop("all"), "part", "inner")
                 .withColumn("gid", F.col("before") + F.col("at") - F.col("first")).select(*groups.columns, "gid"), "merkle-groups")


def pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """(gid, pos, s0..., h): the parents of ``nodes(gid, pos, h)``, children in slot columns."""
    slot = F.col("pos") % fanout
    slots = [f"s{i}" for i in range(fanout)]
    up = nodes.groupBy("gid", F.floor(F.col("pos") / fanout).alias("up")).agg(
        *[F.max(F.when(slot == i, F.col("h"))).alias(s) for i, s in enumerate(slots)])
    return up.select("gid", F.col("up").alias("pos"), *slots, F.sha2(F.concat_ws("", *slots), 256).alias("h"))


def levels(nodes: DataFrame, sizes: DataFrame, fanout: int) -> list[DataFrame]:
    """Pivoted levels above ``nodes``, lowest first; ``sizes(gid, n)``: leaves of each tree.

    A tree that has come down to one node takes no part in the levels above.
    """
    out, n = [], F.col("n")
    while (most := sizes.agg(F.max("n")).first()[0] or 0) > 1:
        # Only trees with more than one node go on; they are told by their sizes, a row per tree.
        more = sizes.where(n > 1)
        out.append(saved(pivot(matching(nodes, more.select("gid"), "gid", "left_semi"), fanout), "merkle-level"))
        nodes = out[-1].select("gid", "pos", "h")
        sizes = sizes.select("gid", F.when(n > 1, F.ceil(n / fanout)).otherwise(F.lit(0)).alias("n"))
        if most <= fanout:
            break
    return out


def step(slot: Column, fanout: int) -> Column:
    """(before, after): the parent's slot columns without the own one."""
    return F.struct(F.concat_ws("", *[F.when(slot > i, F.col(f"s{i}")) for i in range(fanout)]).alias("before"),
                    F.concat_ws("", *[F.when(slot < i, F.col(f"s{i}")) for i in range(fanout)]).alias("after"))


def paths(tree: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame | None:
    """The lowest level of ``tree`` with ``above`` (steps from its nodes to the root) and ``top``.

    ``tops(gid, above, top)`` goes on from each tree's own root.
    """
    known = None
    slots = [f"s{i}" for i in range(fanout)]
    for level in reversed(tree):
        here = level.drop("h").withColumnRenamed("pos", "place")
        # A node at place 0 whose tree has no level above is its tree's root; there is one per tree.
        roots = here.where("place = 0").join(tops, "gid")
        if known is not None:
            up = known.withColumnRenamed("place", "up")
            child = here.select(F.col("gid"), "place", F.floor(F.col("place") / fanout).alias("up"),
                                F.struct(*slots).alias("own"))
            below = (child.join(up, ["gid", "up"])
                          .withColumn("above", F.concat(F.array(step(F.col("place") % fanout, fanout)), "above"))
                          .select("gid", "place", *[F.col(f"own.{s}").alias(s) for s in slots], "above", "top"))
            roots = below.unionByName(roots.join(known.select("gid").distinct(), "gid", "left_anti"))
        known = saved(roots.select("gid", "place", *slots, "above", "top"), "merkle-paths")
    return known


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and the steps of its proof give."""
    return F.aggregate(path, start, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields=FIELDS, fanout: int = FANOUT,
             altered: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, tested, folded_root, verified) per row of ``docs``.

    ``path`` holds the siblings before and after the own node, level by
    level up to the root (no step where a node is alone).  ``tested`` is the leaf
    of the row with the columns of ``altered`` in place of its own, ``folded_root`` what it and ``path``
    give, ``verified`` whether that is the root.

    Null values are marked in the leaf, a null group is the first group, a
    null id the first of its group.  Rows of equal id are ordered by their leaf; rows
    with equal leaves are interchangeable.  A group of one row is its own subroot, a
    single group's subroot the root; an empty table gives an empty result.
    Columns other than ``fields``, id and group are not read.
    """
    altered = altered or {}
    own = [F.col(c) for c in fields]
    rows = saved(docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).alias("doc_id"), leaf(own).alias("leaf"),
                             leaf([altered.get(c, F.col(c)) for c in fields]).alias("tested")), "merkle-leaves")
    ranged, spans = placed(rows, "grp", ["doc_id", "leaf"])
    groups = numbered(spans.groupBy("grp").agg(F.sum("c").alias("n")), "grp")
    spans = null_safe(spans.drop("c"), "grp", "g").drop("grp").join(null_safe(groups, "grp", "g").drop("grp"), ["g_k", "g_n"])
    spans = saved(spans.withColumnRenamed("part", "of"), "merkle-offsets")
    # One row of offsets per group and range: where they are too many to broadcast, no key of the join is hot.
    at = null_safe(ranged, "grp", "r")
    nodes = matching(at, spans, (at["r_k"] == spans["g_k"]) & (at["r_n"] == spans["g_n"]) & (at["part"] == spans["of"]), "inner")
    nodes = saved(nodes.select("gid", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "n", "doc_id", "leaf", "tested"), "merkle-nodes")

    trees = levels(nodes.select("gid", "pos", F.col("leaf").alias("h")), groups.select("gid", "n"), fanout)
    lone = nodes.where("n = 1").select("gid", F.col("leaf").alias("top"))
    tops = lone
    for k, level in enumerate(trees):
        nexts = trees[k + 1].select("gid").distinct() if k + 1 < len(trees) else None
        ended = level.where("pos = 0").select("gid", F.col("h").alias("top"))
        tops = tops.unionByName(ended if nexts is None else ended.join(nexts, "gid", "left_anti"))
    tops = saved(tops, "merkle-subroots")

    upper = levels(tops.select(F.lit(0).cast("bigint").alias("gid"), F.col("gid").alias("pos"), F.col("top").alias("h")),
                   tops.select(F.lit(0).cast("bigint").alias("gid")).groupBy("gid").agg(F.count(F.lit(1)).alias("n")), fanout)
    last = upper[-1].select(F.col("h").alias("top")) if upper else tops.select("top")
    found = last.limit(1).collect()                              # one digest
    root = F.lit(found[0][0] if found else None).cast("string")
    none = F.array().cast(PATH)
    if upper:
        way = paths(upper, upper[-1].select("gid", none.alias("above"), root.alias("top")), fanout).drop("gid", "top")
        tops = (tops.withColumn("place", F.floor(F.col("gid") / fanout)).join(way, "place")
                    .select("gid", F.concat(F.array(step(F.col("gid") % fanout, fanout)), "above").alias("above"), "top"))
    else:
        tops = tops.select("gid", none.alias("above"), "top")
    tops = saved(tops, "merkle-tops")

    cols = ["doc_id", "leaf", "tested", F.col("top").alias("subroot")]
    out = nodes.where("n = 1").join(tops, "gid").select(*cols, F.col("above").alias("path"))
    if trees:
        way = paths(trees, tops, fanout)
        leaves = nodes.where("n > 1").withColumn("place", F.floor(F.col("pos") / fanout))
        out = out.unionByName(leaves.join(way, ["gid", "place"]).select(
            *cols, F.concat(F.array(step(F.col("pos") % fanout, fanout)), "above").alias("path")))
    out = out.withColumn("root", root).withColumn("folded_root", fold(F.col("path"), F.col("tested")))
    return out.select("doc_id", "leaf", "subroot", "root", "path", "tested", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered(divisor: int = 5, id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """``altered`` of the tamper test: A-Z lower-cased where the divisor divides crc32(decimal id)."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor == 0
    return {text_col: F.when(hit, F.translate(F.col(text_col), UPPER, LOWER)).otherwise(F.col(text_col))}


def proofs(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the manifest under the tamper test, the proof digested."""
    found = manifest(docs, altered=tampered(), **kw)
    siblings = F.concat_ws("", F.transform("path", lambda x: F.concat(x["before"], x["after"])))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified")
