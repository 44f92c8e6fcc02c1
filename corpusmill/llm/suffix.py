"""Repeated passages by merging the Burrows-Wheeler transforms of shards.

A byte goes if a run of ``length`` bytes that covers it also starts in a
document with a smaller id.

How the work is dealt out.  Every window of ``length`` bytes has a
fingerprint, the least hash of the 16-byte strings in it, so equal windows have equal
fingerprints.  Windows that follow one another with the same fingerprint make
up a segment.  Segments whose fingerprint no other document has cannot
repeat and end there; the others go, each distinct one once per group of documents, to the
task that owns the fingerprint.

What such a task does.  The segments of neighbouring groups of documents, about ``SHARD`` bytes
of them, are a shard, so more groups do not make more and smaller shards.  Each
shard has its own transform: its suffixes in order, the symbols that stand before
each of them, and the step to the suffix that begins with these.  The shards'
transforms are merged without comparing suffixes again: an interleave of all
shards, right for the first h bytes, becomes right for the next symbol's more by one
stable pass over the symbols that the transforms hold.  Where the interleave
first tells two neighbours apart is their common prefix; the intervals that are
still together after ``length`` bytes are the repeats.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import prepare

LENGTH = 50
GRAM = 16
GROUP_BYTES = 8 << 20
SLICE = 1 << 18              # windows hashed at a time
BATCH = 1 << 20              # bytes of segments merged at a time (a fingerprint's family is never cut)
SHARD = 1 << 16              # bytes of a shard of theirs
NO_ID = np.iinfo(np.int64).max
STEP = 2                     # bytes in a symbol of the transforms


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values."""
    s = 1
    while s * 2 <= w:
        a = np.minimum(a[:-s], a[s:])
        s *= 2
    return np.minimum(a[:len(a) - (w - s)], a[w - s:]) if s < w else a


def window_prints(buf: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The fingerprint of every window of ``length`` bytes."""
    h, m, n = buf.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while n < gram:                              # the hash of 2n bytes from two of n
        h = h[:-n] * np.uint64(m) + h[n:]
        m, n = m * m % (1 << 64), n * 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return sliding_min(h, length - gram + 1)


def segments(texts: list, length: int = LENGTH):
    """(document index, fingerprints, first windows, numbers of windows) for slices of the documents."""
    for d, t in enumerate(texts):
        n = len(t) - length + 1 if t else 0
        for at in range(0, n, SLICE):
            count = min(SLICE, n - at)
            g = window_prints(np.frombuffer(t, np.uint8, count + length - 1, at), length)
            start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            yield d, g[start], start + at, np.diff(start, append=count)


def gather(table: pa.Table) -> tuple[np.ndarray, list, list]:
    """Ids (a missing one counts as larger than all), UTF-8 texts and rows of a group, in order of id and text.

    The order lets two passes over a group number its segments alike.
    """
    ids = pc.fill_null(table.column("doc_id").combine_chunks().cast(pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False)
    texts = [x or b"" for x in table.column("text").combine_chunks().cast(pa.binary()).to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], order


@functools.cache
def zstd() -> tuple:
    """A process's compressor and decompressor: blocks are many and small, so they are not made for each."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(a) -> bytes:
    return zstd()[0].compress(a if isinstance(a, bytes) else a.tobytes())


def unpacked(x: bytes, kind=None):
    data = zstd()[1].decompress(x)
    return data if kind is None else np.frombuffer(data, kind)


def own_prints(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """A group's distinct fingerprints by bucket; ``many`` marks those in two or more of its documents."""
    _, texts, _ = gather(table)
    found = [(g, np.full(len(g), d, np.int32)) for d, g, _, _ in segments(texts, length)]
    g = np.concatenate([x[0] for x in found]) if found else np.empty(0, np.uint64)
    d = np.concatenate([x[1] for x in found]) if found else np.empty(0, np.int32)
    order = np.argsort(g, kind="stable")
    g, d = g[order], d[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, np.int64)
    many = np.maximum.reduceat(d, first) != np.minimum.reduceat(d, first) if len(g) else np.empty(0, bool)
    g = g[first]
    bucket = (g % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    g, many, bucket = g[order], many[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(g) else np.empty(0, np.int64)
    ends = np.append(cut[1:], len(g))
    return pa.table({"bucket": pa.array(bucket[cut]), "g": pa.array([table.column("g")[0].as_py()] * len(cut), pa.int64()),
                     "prints": pa.array([g[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()),
                     "many": pa.array([np.packbits(many[i:j]).tobytes() for i, j in zip(cut, ends)], pa.binary())})


def shared_prints(table: pa.Table) -> pa.Table:
    """For every group, those of its fingerprints in this bucket that another document has too."""
    groups = table.column("g").to_pylist()
    prints = [np.frombuffer(x, np.uint64) for x in table.column("prints").to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(p)).astype(bool) for m, p in zip(table.column("many").to_pylist(), prints)]
    # All groups' at once: a look at the bucket's fingerprints for every group would take time with the square of the groups.
    _, at, count = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
    twice = np.split(count[at] > 1, np.cumsum([len(p) for p in prints])[:-1])
    kept = [p[m | t] for p, m, t in zip(prints, many, twice)]
    some = [(g, k.tobytes()) for g, k in zip(groups, kept) if len(k)]
    return pa.table({"g": pa.array([g for g, _ in some], pa.int64()), "prints": pa.array([k for _, k in some], pa.binary())})


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def shared_segments(docs: pa.Table, shared: pa.Table, length: int, buckets: int) -> pa.Table:
    """A group's distinct segments with a shared fingerprint, and the least id that has each, by bucket."""
    keep = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in shared.column("prints").to_pylist()] or [np.empty(0, np.uint64)]))
    ids, texts, _ = gather(docs)
    least: list[dict] = [{} for _ in range(buckets)]
    for d, g, start, n in segments(texts, length) if len(keep) else ():
        t, own = texts[d], int(ids[d])
        pick = np.flatnonzero(member(g, keep))
        for b, i, j in zip((g[pick] % np.uint64(buckets)).tolist(), start[pick].tolist(), (start[pick] + n[pick] + length - 1).tolist()):
            s = t[i:j]
            seen = least[b].get(s)
            if seen is None or own < seen:
                least[b][s] = own
    rows = [b for b in range(buckets) if least[b]]
    return pa.table({"bucket": pa.array(rows, pa.int64()), "g": pa.array([docs.column("g")[0].as_py()] * len(rows), pa.int64()),
                     "bytes": pa.array([packed(b"".join(least[b])) for b in rows], pa.binary()),
                     "sizes": pa.array([packed(np.fromiter(map(len, least[b]), np.int32, len(least[b]))) for b in rows], pa.binary()),
                     "least": pa.array([packed(np.fromiter(least[b].values(), np.int64, len(least[b]))) for b in rows], pa.binary())})


def transform(buf: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The transform of one shard, a collection of strings.

    Returns, for the suffixes in order: where they start, the symbol (``STEP`` bytes) before each, and the
    rank of the suffix that begins with that symbol (-1 where the string has no such bytes).  A suffix ends
    with its string; the order looks at eight bytes, then at eight more of those that tie, and so on.
    """
    n, at = len(buf), np.cumsum(sizes) - sizes
    # Positions 0..size of every string, the empty suffix too; they are numbered with one more slot per string.
    slots = sizes + 1
    pos = np.arange(n + len(sizes)) - np.repeat(np.arange(len(sizes)), slots)
    left = np.repeat(at + sizes, slots) - pos
    # With eight zeros behind every string the eight bytes from any place on are a word, zero beyond the string's end.
    spot = pos + np.repeat(np.arange(len(sizes)) * 8, slots)
    word = np.zeros(n + 8 * len(sizes) + 8, np.uint64)
    word[spot[left > 0]] = buf
    for k in (1, 2, 4):
        word = (word[:-k] << np.uint64(8 * k)) | word[k:]
    order = np.argsort(word[spot])
    k = word[spot[order]]
    depth, tied = 0, np.arange(len(pos))         # places in the order that still tie with a neighbour
    block = np.zeros(len(pos), np.int64)
    while True:
        new = np.append(True, (k[1:] != k[:-1]) | (block[1:] != block[:-1]))
        alone = new & np.append(new[1:], True)
        block = np.cumsum(new)[~alone]
        tied = tied[~alone]
        depth += 8
        if not len(tied) or depth >= LENGTH:
            break
        i = order[tied]
        k = word[spot[i] + np.minimum(left[i], depth)]
        o = np.lexsort((k, block))
        order[tied], k, block = i[o], k[o], block[o]
    rank = np.empty(len(pos), np.int64)
    rank[order] = np.arange(len(pos))
    offset = (np.repeat(sizes, slots) - left)[order]
    start = pos[order]
    symbol = np.zeros(len(pos), np.uint16)
    has = offset >= STEP
    for k in range(STEP, 0, -1):
        symbol[has] = (symbol[has] << 8) | buf[start[has] - k]
    before = np.where(has, rank[np.maximum(order - STEP, 0)], -1)
    return order, symbol, before


def merge(transforms: list, depth: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Merge shards' transforms to ``depth`` bytes by refining their interleave.

    ``transforms``: (ranks of the suffixes to start from, symbols, steps) per shard.  Returns the
    places (rank counted over all shards) that still share ``depth`` bytes with another,
    in order, with a mark where each interval starts, and how many places each pass told apart
    (those have a common prefix below that pass's depth).
    """
    base = np.cumsum([0] + [len(s) for _, s, _ in transforms])
    symbol = np.concatenate([s for _, s, _ in transforms])
    step = np.concatenate([b + o for (_, _, b), o in zip(transforms, base)])
    place = np.concatenate([r + o for (r, _, _), o in zip(transforms, base)])      # the interleave: shard after shard
    head = np.zeros(len(place), bool)
    head[:1] = True
    apart = []
    for _ in range(depth // STEP):
        if not len(place):
            break
        block = np.cumsum(head, dtype=np.int32)
        s = symbol[place]
        o = np.argsort(s, kind="stable")
        s, block, place = s[o], block[o], step[place[o]]
        head = np.append(True, (s[1:] != s[:-1]) | (block[1:] != block[:-1]))
        alone = head & np.append(head[1:], True)
        apart.append(int(alone.sum()))
        place, head = place[~alone], head[~alone]
    return place, head, apart


def first_holders(strings: list, owner: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the strings the least owner among all strings that hold it.

    Returns intervals of equal answers: string, first window, end, owner.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    order = np.argsort(group, kind="stable")     # group after group
    buf = np.frombuffer(b"".join([strings[i] for i in order.tolist()]), np.uint8)
    sizes_o, owner_o = sizes[order], owner[order]
    ends = np.cumsum(sizes_o)
    shard = (ends - sizes_o) // SHARD
    cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    parts, starts = [], []
    for i, j in zip(cut, np.append(cut[1:], len(order))):
        lo = ends[i] - sizes_o[i]
        own = sizes_o[i:j]
        suffixes, symbol, before = transform(buf[lo:ends[j - 1]], own)
        slot_string = np.repeat(np.arange(i, j), own + 1)
        slot_offset = np.arange(len(slot_string)) - np.repeat(np.cumsum(own + 1) - own - 1, own + 1)
        # Start from the suffixes that stand at the end of a window: whole symbols lead back to its start.
        lead = np.flatnonzero(slot_offset[suffixes] >= length)
        parts.append((lead, symbol, before))
        starts.append((slot_string[suffixes], slot_offset[suffixes]))
    string = np.concatenate([x for x, _ in starts])
    offset = np.concatenate([x for _, x in starts])
    place, head, _ = merge(parts, length)
    windows = sizes_o - length + 1
    begin = np.cumsum(windows) - windows
    best = np.repeat(owner_o, windows)
    if len(place):
        at = np.flatnonzero(head)
        least = np.minimum.reduceat(owner_o[string[place]], at)
        best[begin[string[place]] + offset[place]] = np.repeat(least, np.diff(at, append=len(place)))
    whose = np.repeat(np.arange(len(order)), windows)
    cut = np.flatnonzero(np.append(True, (whose[1:] != whose[:-1]) | (best[1:] != best[:-1])))
    end = np.append(cut[1:], len(whose))
    back = np.argsort(order[whose[cut]], kind="stable")
    return order[whose[cut]][back], (cut - begin[whose[cut]])[back], (end - begin[whose[cut]])[back], best[cut][back]


def verdicts(table: pa.Table, length: int) -> pa.Table:
    """For every group, the segments in this bucket and which earlier document holds which of their windows."""
    number: dict = {}
    owner: list = []
    group: list = []
    sent = []
    for row, (data, sizes, least) in enumerate(zip(*(table.column(c).to_pylist() for c in ("bytes", "sizes", "least")))):
        data, ends = unpacked(data), np.cumsum(unpacked(sizes, np.int32), dtype=np.int64).tolist()
        own, at = [], 0
        for end, who in zip(ends, unpacked(least, np.int64).tolist()):
            s = data[at:end]
            at = end
            k = number.setdefault(s, len(owner))
            if k == len(owner):
                owner.append(who)
                group.append(row)
            elif who < owner[k]:
                owner[k] = who
            own.append(k)
        sent.append(np.array(own, np.int64))
    strings, owner, group = list(number), np.array(owner, np.int64), np.array(group, np.int64)
    del number
    # Families of one fingerprint, as many at a time as make up a batch.
    many = SLICE // length
    family = np.concatenate([window_prints(np.frombuffer(b"".join([s[:length] for s in strings[i:i + many]]), np.uint8), length)[::length]
                             for i in range(0, len(strings), many)])
    order = np.argsort(family, kind="stable")
    size = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings))[order])
    new = np.flatnonzero(np.append(True, family[order][1:] != family[order][:-1]))
    found, i = [], 0
    while i < len(order):
        want = (size[i - 1] if i else 0) + BATCH
        j = int(np.searchsorted(size, want, "right"))
        nxt = np.searchsorted(new, j, "right")
        j = int(new[nxt - 1]) if new[nxt - 1] > i else int(new[nxt]) if nxt < len(new) else len(order)
        if len(order) and size[-1] <= want:
            j = len(order)
        pick = order[i:j]
        s, a, b, w = first_holders([strings[k] for k in pick.tolist()], owner[pick], group[pick], length)
        found.append((pick[s], a, b, w))
        i = j
    s, a, b, w = (np.concatenate(x) for x in zip(*found))
    back = np.argsort(s, kind="stable")
    s, a, b, w = s[back], a[back].astype(np.int32), b[back].astype(np.int32), w[back]
    lo, hi = np.searchsorted(s, np.arange(len(strings))), np.searchsorted(s, np.arange(len(strings)), "right")
    out = {n: [] for n in ("prints", "counts", "from", "to", "owner")}
    for own in sent:
        count = hi[own] - lo[own]
        at = np.repeat(lo[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        for n, v in (("prints", np.unique(family[own])), ("counts", count.astype(np.int32)), ("from", a[at]), ("to", b[at]), ("owner", w[at])):
            out[n].append(packed(v))
    return pa.table({"g": table.column("g").cast(pa.int64()), "bucket": table.column("bucket").cast(pa.int64()),
                     **{n: pa.array(v, pa.binary()) for n, v in out.items()}})


def covered(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals (touching ones join)."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def removed_runs(docs: pa.Table, said: pa.Table, length: int, buckets: int) -> tuple[list, list, list]:
    """(texts, runs to remove or None per text, rows) of a group, in order of id and text."""
    ids, texts, rows = gather(docs)
    prints, answers = [np.empty(0, np.uint64)], {}
    for b, p, *cols in zip(*(said.column(c).to_pylist() for c in ("bucket", "prints", "counts", "from", "to", "owner"))):
        prints.append(unpacked(p, np.uint64))
        count, lo, hi, who = (unpacked(x, t) for x, t in zip(cols, (np.int32, np.int32, np.int32, np.int64)))
        end = np.cumsum(count, dtype=np.int64)
        answers[b] = ((end - count).tolist(), end.tolist(), lo.tolist(), hi.tolist(), who.tolist())
    prints = np.sort(np.concatenate(prints))
    number: list[dict] = [{} for _ in range(buckets)]
    runs: list = [[] for _ in texts]
    for d, g, start, n in segments(texts, length) if len(prints) else ():
        t, own = texts[d], int(ids[d])
        pick = np.flatnonzero(member(g, prints))
        for b, i, j in zip((g[pick] % np.uint64(buckets)).tolist(), start[pick].tolist(), (start[pick] + n[pick] + length - 1).tolist()):
            seen = number[b]
            k = seen.setdefault(t[i:j], len(seen))
            first, end, lo, hi, who = answers[b]
            for x in range(first[k], end[k]):
                if who[x] < own != NO_ID:
                    runs[d].append((i + lo[x], i + hi[x] + length - 1))
    return texts, [covered(*np.array(r, np.int64).T) if r else None for r in runs], rows


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for every row of ``docs``.

    Texts are judged as UTF-8 bytes on the input, not on what is left; matches never cross
    documents.  Null text is empty; texts shorter than ``length`` keep everything; rows that
    share an id do not count as earlier for one another; a row without an
    integer id is later than all, but nothing is taken from it.  ``kept``: the
    remaining bytes.  An empty table gives an empty result; other columns are not read.

    Documents are dealt into groups of about ``GROUP_BYTES``, once; the three passes over
    them share that exchange.  A passage that a third of all documents
    has costs its task one segment per group, not per document.  ``length`` has to be a multiple of ``STEP``.
    """
    spark = docs.sparkSession
    prepare(spark)
    if length % STEP or length < GRAM:
        raise ValueError("length must be a multiple of the symbol size, and at least the gram size")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(n, math.ceil(size / GROUP_BYTES))
    dealt = src.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))).repartition(n, "g")
    shared = (dealt.groupBy("g").applyInArrow(lambda t: own_prints(t, length, n), "bucket bigint, g bigint, prints binary, many binary")
              .groupBy("bucket").applyInArrow(shared_prints, "g bigint, prints binary"))
    found = (dealt.groupBy("g").cogroup(shared.groupBy("g"))
             .applyInArrow(lambda d, s: shared_segments(d, s, length, n), "bucket bigint, g bigint, bytes binary, sizes binary, least binary"))
    said = found.groupBy("bucket").applyInArrow(
        lambda t: verdicts(t, length), "g bigint, bucket bigint, prints binary, counts binary, from binary, to binary, owner binary")

    def result(d, s):
        texts, runs, rows = removed_runs(d, s, length, n)
        out = []
        for t, r in zip(texts, runs):
            if r is None:
                kept, gone, spans = t, 0, 0
            else:
                at = [0, *np.stack(r, 1).ravel().tolist(), len(t)]
                kept, gone, spans = b"".join([t[i:j] for i, j in zip(at[::2], at[1::2])]), int((r[1] - r[0]).sum()), len(r[0])
            out.append((len(t), gone, spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = {"doc_id": d.column("doc_id").take(pa.array(rows, pa.int64())), **{c: pa.array([x[k] for x in out], kind) for k, (c, kind) in enumerate(
            [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])}}
        if with_text:
            cols["kept"] = pa.array([x[4] for x in out], pa.binary())
        return pa.table(cols)
    return dealt.groupBy("g").cogroup(said.groupBy("g")).applyInArrow(
        result, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_text else ""))
