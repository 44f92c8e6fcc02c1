"""Exact and near-duplicate removal.

Text never crosses a shuffle here: keys are md5 / 64-bit hashes and the
shuffled rows are (key, doc_id).  Survivors are re-attached to the
documents through a semi/anti join on doc_id whose small side is broadcast
only after its size is measured.

Near duplicates are found by an exact set-similarity join over word
5-shingles: sets are indexed under their rarest shingles only (prefix
filter), with length and position bounds and parity bitmaps before the exact
Jaccard.  Clusters are linked by stars, and connected components are found by iterative
min-label propagation with reliable checkpoints between rounds.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.clean import keep_if
from corpusmill.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, checked_join, drop_keys, materialize, stored


# --- B7 ---------------------------------------------------------------------

def _dup_groups(keyed: DataFrame, id_col: str) -> DataFrame:
    """(k, keep_id) for keys held by two or more documents (partial aggregation on k)."""
    return (keyed.groupBy("k").agg(F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("_n_"))
                 .where(F.col("_n_") > 1).select("k", "keep_id"))


def exact_dup_map(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, keep_id) for every document that has an exact copy (keep_id = smallest id of its key)."""
    keyed = df.select(F.col(id_col), tx.dedup_key(text_col).alias("k"))
    return checked_join(keyed, _dup_groups(keyed, id_col), "k", "inner", max_broadcast_rows) \
        .select(id_col, "keep_id")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Keep the smallest doc_id per md5(lower(collapse_ws(trim(text)))).

    Only (key, id) is shuffled, once, for the per-key aggregation (partial
    aggregation absorbs a hot key).  The keys that actually have copies are
    usually few: that table is measured and broadcast, so finding the ids to
    drop needs no second shuffle, and the ids to drop are in turn measured
    before the final anti join.
    """
    keyed = df.select(F.col(id_col), tx.dedup_key(text_col).alias("k"))
    dups = (checked_join(keyed, _dup_groups(keyed, id_col), "k", "inner", max_broadcast_rows)
            .where(F.col(id_col) != F.col("keep_id")).select(id_col))
    return drop_keys(df, dups, id_col, max_broadcast_rows)


# --- shingles / MinHash -----------------------------------------------------

def shingle_hashes(df: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sh: array<bigint>) distinct hashed word n-shingles of lower(text).

    Documents with fewer than n words get an empty array (they never match).
    """
    return df.select(F.col(id_col),
                     F.array_distinct(tx.ngram_hashes(tx.words(F.lower(F.col(text_col))), n)).alias("sh"))


def jaccard_expr(a, b) -> "F.Column":
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return tx.round6(inter.cast("double") / union.cast("double"))


BITMAP_WORDS = 8             # 512 bits of parity per set
PAIRS_PER_TASK = 4_000_000   # comparisons within one shingle that a task makes


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(id, bits: array<bigint>): the parity of the set's hashes per residue.

    One element more or less flips one bit, so two sets that differ in d elements
    differ in at most d bits: a bound that needs no look at the sets.
    """
    size = 64 * BITMAP_WORDS

    @F.pandas_udf("array<bigint>")
    def parity(col: pd.Series) -> pd.Series:
        odd = [np.bincount(np.asarray(a, dtype=np.int64) & (size - 1), minlength=size) & 1 for a in col]
        return pd.Series([np.packbits(x.astype(np.uint8)).view(np.int64) for x in odd])
    return sets.select("id", parity("sh").alias("bits"))


def rare_prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, len, s, upto): the shingles by which a set can meet one that is similar enough.

    Shingles are ordered from rare to frequent (ties by hash).  Two sets of
    Jaccard t or more have their first common shingle, in that order, among the
    first len - ceil(t * len) + 1 of either.  Shingles of one set only come first
    and meet nothing, so a set with that many of its own needs no row at all, and only
    shared shingles are ordered.  A shingle at place i of x leaves at most len - i in
    common, which bounds the length of a partner: ``upto`` (the position filter).
    """
    # Counted where its holders are: the shingles cross the shuffle once, and only shared ones go on.
    held = (sets.select("id", F.size("sh").alias("len"), F.explode("sh").alias("s"))
                .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("s"))).where(F.col("n") > 1))
    own = held.groupBy("id", "len").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("ts"))
    alone = F.col("len") - F.size("ts")
    take = F.col("len") - F.ceil(F.col("len") * threshold).cast("int") + 1 - alone
    rows = (own.where(take > 0).withColumn("alone", alone)
               .select("id", "len", "alone", F.posexplode(F.slice("ts", 1, take)).alias("i", "t")))
    left = F.col("len") - F.col("alone") - F.col("i")          # may be in common, this shingle included
    upto = F.floor(left * (1 + threshold) / threshold + 1e-6) - F.col("len")
    return (rows.select("id", "len", F.col("t.s").alias("s"), upto.cast("int").alias("upto"))
                .where(F.col("upto") >= F.ceil(F.col("len") * threshold - 1e-6)))


def _may_match(x: str, y: str, threshold: float) -> "F.Column":
    """Lengths within each other's bounds, and bitmaps that differ in no more bits than the sets may."""
    differ = F.lit(0)
    for i in range(BITMAP_WORDS):
        differ = differ + F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i]))
    most = (F.col(f"{x}.len") + F.col(f"{y}.len")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    return (F.col(f"{x}.len") <= F.col(f"{y}.upto")) & (F.col(f"{y}.len") <= F.col(f"{x}.upto")) & (differ <= most)


def _verified(cand: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard) of candidate pairs whose shingle sets are similar enough."""
    return (cand.join(sets.select(F.col("id").alias("a"), F.col("sh").alias("sa")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("sh").alias("sb")), "b")
                .select("a", "b", jaccard_expr("sa", "sb").alias("jaccard"))
                .where(F.col("jaccard") >= threshold))


def _near_index(sets: DataFrame, t: float) -> tuple[DataFrame, DataFrame]:
    """The rows of ``rare_prefixes`` that can meet another, with bitmaps, and the sets that have such rows."""
    rows = stored(rare_prefixes(sets, t), "near-prefixes")
    # A pair holds a set that may have partners of its own length or more: shingles without one meet nothing.
    meet = rows.groupBy("s").agg(F.count(F.lit(1)).alias("m"), F.max(F.col("upto") >= F.col("len")).alias("open"))
    rows = checked_join(rows, stored(meet.where((F.col("m") > 1) & F.col("open")).select("s"), "near-meet"), "s", "left_semi")
    rows = stored(rows, "near-rows")
    live = rows.select("id").distinct()
    sets = stored(checked_join(sets, stored(live, "near-live"), "id", "left_semi"), "near-live-sets")
    return stored(rows.join(_bitmaps(sets), "id"), "near-index"), sets


def _in_pairs(rows: DataFrame, key: str) -> DataFrame:
    """Rows x and y of equal ``key`` and unequal ``id``, each two of them once (null ids meet nothing).

    A key with more than PAIRS_PER_TASK pairs is cut: its rows are dealt to strips, and each two strips are a task's.
    """
    most = F.col("m") * F.col("m") / (2.0 * PAIRS_PER_TASK)
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("m")).where(most > 1)
    hot = stored(hot.select(key, F.ceil(F.sqrt(most)).cast("int").alias("strips")), "near-hot")
    n_hot = hot.count()
    if n_hot == 0:
        return rows.alias("x").join(rows.alias("y"), key).where(F.col("x.id") < F.col("y.id"))
    rows = checked_join(rows, hot, key, "left", small_rows=n_hot).withColumn("strips", F.coalesce("strips", F.lit(1)))
    rows = rows.withColumn("strip", F.pmod(F.xxhash64("id"), F.col("strips")).cast("int"))
    x = rows.withColumn("i", F.col("strip")).withColumn("j", F.explode(F.sequence("strip", F.col("strips") - 1)))
    y = rows.withColumn("j", F.col("strip")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("strip"))))
    return (x.alias("x").join(y.alias("y"), [key, "i", "j"])
             .where((F.col("x.id") < F.col("y.id")) | ((F.col("i") < F.col("j")) & (F.col("x.id") != F.col("y.id")))))


def _every_pair(sh: DataFrame, threshold: float, t: float) -> DataFrame:
    """(a, b, jaccard) for each two rows of (id, sh, sig) that are similar enough, unless their ids are equal or null.

    Equal sets are compared once, under their ``sig``; the similar pairs of sets then become pairs of their holders.
    """
    sh = sh.where(F.col("id").isNotNull())
    held = stored(sh.select("sig", "id"), "near-holders")
    rep = held.groupBy("sig").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
    rep = stored(rep.where(F.col("m") > 1).select("sig", "rep"), "near-reps")
    twins = stored(checked_join(held, rep, "sig", small_rows=rep.count()), "near-twins")
    sets = drop_keys(sh, twins.where(F.col("id") != F.col("rep")).select("sig", "id"), ["sig", "id"])
    rows, sets = _near_index(sets.select(F.col("sig").alias("id"), "sh"), t)
    met = (_in_pairs(rows, "s").where(_may_match("x", "y", t))
           .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    alike = stored(_verified(stored(met, "near-met"), sets, threshold).distinct(), "near-alike")
    across = (alike.join(held.select(F.col("sig").alias("a"), F.col("id").alias("x")), "a")
                   .join(held.select(F.col("sig").alias("b"), F.col("id").alias("y")), "b").where(F.col("x") != F.col("y"))
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard"))
    equal = _in_pairs(twins.select("sig", "id"), "sig").select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"),
                                                               F.lit(1.0).alias("jaccard"))
    return across.unionByName(equal)


def near_dup_pairs(df: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id",
                   text_col: str = "text", every: bool = False) -> DataFrame:
    """Verified near-duplicate edges (a, b, jaccard), a < b, jaccard >= threshold (rounded to 6 places).

    A set-similarity join by prefix filter: it misses no pair.  With ``every`` the edges are all
    similar pairs.  Without it, which is what components need, they
    link all that is similar, directly or over others; not every similar pair is
    an edge of its own, so a group of copies gives edges in proportion to its size:

    1. equal shingle sets are linked to the set's smallest id;
    2. the others meet in the shingles of their prefixes (``rare_prefixes``); each is
       compared with the smallest of those that share a shingle;
    3. what step 2 has not linked: per shingle, the members outside its largest
       component so far are compared with all members of other
       components, in blocks of a shingle's members.  Pairs are compared by lengths and bitmaps in
       place, and only those that may be similar go on to the exact check.

    Step 3 takes comparisons in proportion to (members outside the largest component) x
    (members) of a shingle; they are dealt to tasks in blocks.
    Documents of fewer than ``n`` words, null texts included, have no shingles and no edges.
    """
    t = threshold - 5e-7                                    # the check rounds
    sh = shingle_hashes(df, n, id_col, text_col).withColumnRenamed(id_col, "id")
    # bind the shingle array once (a plain where would recompute it in the filter)
    sh = stored(keep_if(sh, "sh", lambda a: F.size(a) > 0).withColumn("sig", F.xxhash64(F.array_sort("sh"))), "near-sets")
    if every:
        return _every_pair(sh, threshold, t)
    rep = stored(sh.groupBy("sig").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")), "near-reps")
    groups = rep.where(F.col("m") > 1).select("sig", "rep")
    twins = checked_join(sh.select("id", "sig"), groups, "sig", small_rows=groups.count()).where(F.col("id") != F.col("rep"))
    copies = stored(twins.select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("jaccard")), "near-copies")
    sets = sh.select("id", "sh")
    if copies.limit(1).count():
        sets = drop_keys(sets, copies.select(F.col("b").alias("id")), "id", keys_rows=copies.count())
    rows, sets = _near_index(sets, t)
    y = rows.alias("y")
    first = rows.groupBy("s").agg(F.min(F.struct("id", "len", "upto", "bits")).alias("f")).select("s", "f.*")
    star = (first.alias("x").join(y, "s").where((F.col("x.id") < F.col("y.id")) & _may_match("x", "y", t))
                 .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    star = stored(_verified(star, sets, threshold), "near-star")
    found = copies.unionByName(star)
    comp = components(star)
    rows = rows.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    rows = stored(rows, "near-components")
    parts = rows.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("s").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m"), F.count(F.lit(1)).alias("k"))
    blocks = F.ceil((F.col("m") - F.col("top.c")) * F.col("m") / PAIRS_PER_TASK).cast("int")
    mixed = stored(mixed.where(F.col("k") > 1).select("s", F.col("top.comp").alias("top"), blocks.alias("blocks")), "near-mixed")
    n_mixed = mixed.count()
    if n_mixed == 0:
        return found
    rows = stored(checked_join(rows, mixed, "s", small_rows=n_mixed), "near-open")
    x = rows.where(F.col("comp") != F.col("top")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("x")
    y = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).alias("y")
    # Two members outside the largest component meet twice: the smaller id asks.
    once = (F.col("y.comp") == F.col("y.top")) | (F.col("x.id") < F.col("y.id"))
    cross = (x.join(y, ["s", "block"]).where((F.col("x.comp") != F.col("y.comp")) & once & _may_match("x", "y", t))
              .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    return found.unionByName(stored(_verified(cross, sets, threshold), "near-cross"))


# --- B9 ---------------------------------------------------------------------

def components(pairs: DataFrame, a: str = "a", b: str = "b", max_rounds: int | None = None,
               checkpoint_every: int = 1) -> DataFrame:
    """(id, component): connected components, labelled by their smallest id.

    Each round does min-label propagation (every vertex takes the minimum label
    over itself and its neighbours) followed by pointer jumping (a vertex takes
    its label's label), so long chains shrink geometrically instead of one hop
    per round.  Edges are (src, dst) in both directions; a hot label (one
    component holding a third of all vertices) is a skewed join key that AQE's
    skew join splits.  The label table is checkpointed (reliable) every
    ``checkpoint_every`` rounds so plans stay flat and a lost executor replays
    at most that many rounds, not the history.  Stops when no label changes;
    ``max_rounds`` makes a longer run an error, never an unfinished result.
    """
    e = pairs.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    edges = materialize(e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = edges.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("label")) \
                  .withColumnRenamed("src", "id")
    labels = materialize(labels)
    for r in itertools.count():
        if max_rounds is not None and r >= max_rounds:
            raise RuntimeError(f"labels still change after {max_rounds} rounds")
        prop = (edges.join(labels.withColumnRenamed("id", "src"), "src")
                     .groupBy("dst").agg(F.min("label").alias("nl")).withColumnRenamed("dst", "id"))
        step = labels.join(prop, "id", "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("nl", "label")).alias("label"))
        hop = step.select(F.col("id").alias("label"), F.col("label").alias("ll"))
        new = (step.join(hop, "label", "left")
                   .select("id", "old", F.least("label", F.coalesce("ll", "label")).alias("label")))
        new = materialize(new) if (r + 1) % checkpoint_every == 0 else new.persist()
        changed = new.where(F.col("label") < F.col("old")).limit(1).count()
        labels = new.select("id", "label")
        if changed == 0:
            break
    return labels.select("id", F.col("label").alias("component"))


def near_dedup(df: DataFrame, pairs: DataFrame, id_col: str = "doc_id",
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Keep the smallest doc_id of every near-duplicate component."""
    comp = components(pairs)
    dropped = comp.where(F.col("id") != F.col("component")).select(F.col("id").alias(id_col))
    return drop_keys(df, dropped, id_col, max_broadcast_rows)


def dup_components(df: DataFrame, n: int = 5, threshold: float = 0.8, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, component) for every document: exact copies (B7) and near copies (B8) merged."""
    exact = exact_dup_map(df, id_col, text_col).where(F.col(id_col) != F.col("keep_id")) \
        .select(F.col("keep_id").alias("a"), F.col(id_col).alias("b"))
    near = near_dup_pairs(df, n=n, threshold=threshold, id_col=id_col, text_col=text_col).select("a", "b")
    comp = components(exact.unionByName(near))
    ids = df.select(F.col(id_col))
    return (ids.join(comp.withColumnRenamed("id", id_col), id_col, "left")
               .select(id_col, F.coalesce("component", id_col).alias("component")))
