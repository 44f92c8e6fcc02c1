"""SimHash near-duplicate detection with the pigeonring filter.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles.  Fingerprints at ``max_bits`` or fewer differing bits are linked.

The pigeonring principle: cut the 64 bits into ``segments`` equal pieces laid
on a ring.  If two fingerprints differ in at most T bits, then from some
starting segment on *every* chain of l consecutive segments has at most
``l * T / segments`` differences.  The longest chains whose budget rounds down to zero
must be equal, which gives one exact join key per start; the other chain
budgets prune what shares the key before the full Hamming distance is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import fresh, matching, pieces, saved, text_bytes
from corpusmill.llm.graph import components
from corpusmill.session import prepare

CHUNK = 1 << 16


def shingle_hashes(text: bytes | None, shingle: int, seed: int):
    """XXH64 of every run of ``shingle`` words (the whole sequence if there are fewer), in chunks."""
    words = (text or b"").lower().split()          # bytes: lower() is A-Z only, split() is [\x20\x09-\x0D]+
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), CHUNK):
        yield np.array([digest(joined[s:e], seed) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], np.uint64)


def majority(chunks) -> int:
    """A bit is one if it is set in over half the hashes; no hashes: zero."""
    ones, n = np.zeros(64, np.int64), 0
    for h in chunks:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """(doc_id, fp bigint) for every row; null, empty or blank text has fingerprint 0."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = src.select("doc_id", F.lit(0).cast("bigint").alias("fp")).schema

    def run(batches):
        for b in pieces(batches, "text"):
            fp = np.array([majority(shingle_hashes(t, shingle, seed)) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    return src.mapInArrow(run, schema)


def viable(x: np.ndarray, segments: int, max_bits: int) -> np.ndarray:
    """Do all chains from segment 0 on stay within budget?  ``x``: XOR of rotated fingerprints.

    The last chain is the whole ring, so its check is the full Hamming distance.
    """
    bits = 64 // segments
    ok = np.ones(x.shape, bool)
    for chain in range(1, segments + 1):
        budget = chain * max_bits // segments
        if chain < segments and (chain + 1) * max_bits // segments == budget:
            continue                                 # a longer chain with the same budget says more
        mask = np.uint64((1 << (chain * bits)) - 1)
        ok &= np.bitwise_count(x & mask) <= budget
    return ok


def forest(members: np.ndarray, segments: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that span the connected components of one key's members (indexes), not all their pairs."""
    links, rest = [], np.arange(len(members))
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = viable(members[rest] ^ members[at], segments, max_bits)
            links += [(at, r) for r in rest[near]]
            front += list(rest[near])
            rest = rest[~near]
    return links


def links(prints: DataFrame, max_bits: int = 2, segments: int = 16) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose closure is that of all links within ``max_bits``.

    Each distinct fingerprint is dealt once per start of the ring, keyed by
    the chain that has to be equal (28 bits for 2 bits in 16 segments).  A key's
    members are streamed in order through one pass and joined by a spanning
    forest, so copies cost nothing and a family of near copies a row each.
    Needs 64 % segments == 0 and max_bits < segments.
    """
    if 64 % segments or not 0 <= max_bits < segments:
        raise ValueError("segments must divide 64 and exceed max_bits")
    bits = 64 // segments
    zero = max(c for c in range(1, segments + 1) if c * max_bits // segments == 0) if max_bits else segments
    width = zero * bits
    mask = (1 << width) - 1 if width < 64 else -1
    rot = lambda i: F.col("fp") if i == 0 else F.shiftrightunsigned("fp", i * bits).bitwiseOR(F.shiftleft("fp", 64 - i * bits))
    dealt = prints.select("fp").distinct().select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), rot(i).bitwiseAND(F.lit(mask)).alias("key"), rot(i).alias("r"))
        for i in range(segments)])).alias("x")).select("x.*")
    # Keys that only one fingerprint has end here, before anything is sorted.
    dealt = dealt.repartition("start", "key").sortWithinPartitions("start", "key", "r")
    schema = "a bigint, b bigint"

    def run(batches):
        held = None
        for b in batches:
            cols = [b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy(),
                    b.column(2).to_numpy().view(np.uint64)]
            cols = cols if held is None else [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = int(np.flatnonzero((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]))[0])
            yield from linked([c[:last] for c in cols])
            held = [c[last:] for c in cols]          # the last key may go on in the next batch
        if held is not None:
            yield from linked(held)

    def linked(cols):
        start, key, r = cols
        if len(r) < 2:
            return
        cut = np.flatnonzero((start[1:] != start[:-1]) | (key[1:] != key[:-1])) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(r)]])
        for i, j in zip(lo[hi - lo > 1].tolist(), hi[hi - lo > 1].tolist()):
            if found := forest(r[i:j], segments, max_bits):
                back = np.uint64(int(start[i]) * bits)
                pair = r[i:j][np.array(found)]
                pair = pair if not back else (pair << back) | (pair >> (np.uint64(64) - back))
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, c].view(np.int64)) for c in (0, 1)], names=["a", "b"])
    return dealt.mapInArrow(run, schema)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
            max_bits: int = 2, seed: int = 42, segments: int = 16) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row, and (fp, root, component_id) per fingerprint; ``root`` names the component."""
    fps = saved(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    least = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-least")
    comp = components(links(least, max_bits, segments)).select(F.col("v").alias("fp"), "root")
    rooted = least.join(comp, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps, saved(rooted.select("fp", "root").join(saved(smallest, "simhash-small"), "root")
                            .select("fp", "root", "component_id"), "simhash-comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42, segments: int = 16) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    fingerprint: 16 lowercase hex digits.  component_id: the smallest doc_id
    reachable over links of at most ``max_bits`` bits, itself included.  Null,
    empty and blank texts share fingerprint zero and so are one another's
    copies.  Rows that repeat a doc_id keep their own fingerprint; a null
    doc_id is reached like any other but is never a component's smallest
    unless all are null.  An empty table gives an empty result; columns other
    than the two named are not read.
    """
    fps, by_fp = grouped(docs, id_col, text_col, shingle, max_bits, seed, segments)
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
             seed: int = 42, segments: int = 16) -> DataFrame:
    """The rows of ``docs`` less all but one of each near-duplicate group, columns unchanged.

    The row with the group's smallest doc_id stays; of a group without any id one
    row.  Rows with a null or a repeated id are told apart by their fingerprint, which is taken of
    them once more; of those that share their group's smallest id one stays.
    """
    i, f, r, c = fresh(docs, "cm_id", "cm_fp", "cm_root", "cm_component")
    fps, by_fp = grouped(docs, id_col, text_col, shingle, max_bits, seed, segments)
    found = fps.join(by_fp, "fp").select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    ids = saved(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("stays").cast("int")).alias("stay")), "simhash-ids")
    # Ids none of whose rows stays; ids that need a look at their rows.
    gone = ids.where("stay = 0 and doc_id is not null").select(F.col("doc_id").alias(id_col))
    left = matching(docs, saved(gone, "simhash-gone"), id_col, "left_anti")
    again = saved(ids.where("doc_id is null or (rows > 1 and stay > 0)").select(F.col("doc_id").alias(i)), "simhash-again")
    if again.limit(1).count() == 0:
        return left
    on = left[id_col].eqNullSafe(again[i])
    look = matching(left, again, on, "left_semi")
    schema = look.withColumn(f, F.lit(0).cast("bigint")).schema
    at, names = docs.columns.index(text_col), [*docs.columns, f]

    def run(batches):
        for b in pieces(batches, text_col):
            fp = np.array([majority(shingle_hashes(t, shingle, seed)) for t in text_bytes(b.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], names=names)
    looked = saved(look.mapInArrow(run, schema), "simhash-look")
    groups = by_fp.select(F.col("fp").alias(f), F.col("root").alias(r), F.col("component_id").alias(c))
    one = (looked.join(groups, f).where(F.col(id_col).eqNullSafe(F.col(c))).dropDuplicates([r]).select(*docs.columns))
    return matching(left, again, on, "left_anti").unionAll(one)
