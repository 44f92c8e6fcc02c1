import collections
import heapq
import json
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import bpe
from tests.conftest import SF0001


def sequential_bpe(texts, vocab_size, min_count=2):
    """One merge at a time: the textbook definition (ties: smaller left id, then right id)."""
    counts = collections.Counter(w for t in texts for w in re.findall(tx.PRETOKEN_RE.replace("\\t", "\t")
                                                                       .replace("\\n", "\n").replace("\\r", "\r"), t))
    words = {w: [bpe.BYTE_OFFSET + b for b in w.encode("utf-8")] for w in counts}
    merges, nid = [], bpe.FIRST_MERGE_ID
    while nid < vocab_size:
        pc = collections.Counter()
        for w, syms in words.items():
            for a, b in zip(syms, syms[1:]):
                pc[(a, b)] += counts[w]
        cands = [(-n, a, b) for (a, b), n in pc.items() if n >= min_count]
        if not cands:
            break
        _, a, b = min(cands)
        merges.append((a, b, nid))
        for w, syms in words.items():
            out, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                    out.append(nid)
                    i += 2
                else:
                    out.append(syms[i])
                    i += 1
            words[w] = out
        nid += 1
    return merges


CORPORA = [
    ["aaaa aaaa aaaa", "abab abab ab"],
    ["the cat sat on the mat", "the hat", "that cat sat", "ééé éé ü"],
    ["aaa aaa aaaaa bbbb bb b", "abababab baba"],
    ["x y z"],
]


@pytest.mark.parametrize("top_k", [4, 16, 4096])
@pytest.mark.parametrize("texts", CORPORA)
def test_batched_equals_sequential(spark, texts, top_k):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    vocab_size = bpe.FIRST_MERGE_ID + 40
    _, merges = bpe.train_bpe(df, vocab_size=vocab_size, top_k=top_k)
    got = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    assert got == sequential_bpe(texts, vocab_size)


def indexed_bpe(counts, n_merges, min_count=2):
    """One merge at a time with counts kept up to date: the definition, fast enough for thousands of merges."""
    words = [[bpe.BYTE_OFFSET + b for b in w.encode("utf-8")] for w in counts]
    n = list(counts.values())
    pairs, where = collections.Counter(), collections.defaultdict(set)
    for i, w in enumerate(words):
        for p in zip(w, w[1:]):
            pairs[p] += n[i]
            where[p].add(i)
    heap = [(-c, *p) for p, c in pairs.items()]
    heapq.heapify(heap)
    out = []
    while heap and len(out) < n_merges:
        c, a, b = heapq.heappop(heap)
        if pairs.get((a, b), 0) != -c:
            continue
        if -c < min_count:
            break
        new, changed = bpe.FIRST_MERGE_ID + len(out), set()
        out.append((a, b, new))
        for i in where[(a, b)]:
            w, o, k = words[i], [], 0
            for p in zip(w, w[1:]):
                pairs[p] -= n[i]
                changed.add(p)
            while k < len(w):
                if k + 1 < len(w) and (w[k], w[k + 1]) == (a, b):
                    o.append(new)
                    k += 2
                else:
                    o.append(w[k])
                    k += 1
            words[i] = o
            for p in zip(o, o[1:]):
                pairs[p] += n[i]
                where[p].add(i)
                changed.add(p)
        for p in changed:
            if pairs[p] > 0:
                heapq.heappush(heap, (-pairs[p], *p))
    return out


def test_thousands_of_merges_equal_sequential(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    counts = {r["word"]: r["n"] for r in bpe.pretoken_counts(df).collect()}
    _, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 2048)
    got = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    assert got == indexed_bpe(counts, 2048) and len(got) == 2048


def test_merge_symbols_equals_repeated_scans():
    """Lowest rank first, all its occurrences left to right, until nothing merges."""
    rng = random.Random(0)
    for _ in range(300):
        merges, made = [], [1, 2, 3]
        for new in range(10, 10 + rng.randint(1, 8)):
            merges.append((rng.choice(made), rng.choice(made), new))
            made.append(new)
        merges = list({(l, r): (l, r, z) for l, r, z in merges}.values())
        ranks = bpe._ranks(merges)
        word = [rng.choice([1, 2, 3]) for _ in range(rng.randint(0, 30))]
        w = list(word)
        while (best := min((ranks[p] + p for p in zip(w, w[1:]) if p in ranks), default=None)):
            _, new, l, r = best
            o, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and (w[i], w[i + 1]) == (l, r):
                    o.append(new)
                    i += 2
                else:
                    o.append(w[i])
                    i += 1
            w = o
        assert bpe.merge_symbols(word, ranks) == w


def test_a_very_long_word():
    ranks = bpe._ranks([(bpe.BYTE_OFFSET + 97, bpe.BYTE_OFFSET + 98, 300), (300, 300, 301), (301, 301, 302)])
    t = time.time()
    assert bpe.encode_word("ab" * 100_000, ranks) == [302] * 25_000
    assert time.time() - t < 5


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=300)
    assert merges.count() == 0 and vocab.count() == bpe.FIRST_MERGE_ID


def test_select_merges_prefix_rule():
    ranked = [(1, 2, 9), (3, 4, 8), (2, 5, 7), (6, 7, 1)]
    assert bpe.select_merges(ranked, 100) == [(1, 2, 100), (3, 4, 101)]
    assert bpe.select_merges([(1, 1, 9), (2, 3, 8)], 100) == [(1, 1, 100)]


def test_encode_decode_roundtrip_and_hf(spark):
    texts = ["Hello world, hello  there!\n\nnew  para", "naïve café ünïcödé 日本語", "", "   ", "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 30, min_count=1)
    ml = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    enc = bpe.bpe_encode(df, ml)
    dec = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(enc, vocab).collect()}
    assert [dec[i] or "" for i in range(len(texts))] == texts
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_str(bpe.tokenizer_json(ml))
    ours = {r["doc_id"]: list(r["input_ids"]) for r in enc.collect()}
    for i, t in enumerate(texts):
        assert tok.encode(t).ids == ours[i], t
    json.loads(bpe.tokenizer_json(ml))


def test_pair_counts_base(spark):
    df = spark.createDataFrame([(0, "abab")], "doc_id bigint, text string")
    pc = bpe.pair_counts(bpe.word_symbols(bpe.pretoken_counts(df)))
    got = {(r["left_id"], r["right_id"]): r["n"] for r in pc.collect()}
    a, b = bpe.BYTE_OFFSET + ord("a"), bpe.BYTE_OFFSET + ord("b")
    assert got == {(a, b): 2, (b, a): 1}


def test_apply_merges_self_pair(spark):
    df = spark.createDataFrame([("aaaaa", 1)], "word string, n bigint")
    w = bpe.word_symbols(df)
    a = bpe.BYTE_OFFSET + ord("a")
    out = bpe.apply_merges(w, [(a, a, 500)]).select(bpe.symbol_ids("syms").alias("ids")).collect()[0]["ids"]
    assert list(out) == [500, 500, a]


def test_save_and_load_tokenizer(spark, tmp_dir):
    import glob
    import os
    df = spark.createDataFrame([(0, "low lower lowest newer wider")], "doc_id bigint, text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 10, min_count=1)
    path = os.path.join(tmp_dir, "tok")
    bpe.save_tokenizer(vocab, merges, path)
    ml = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    assert bpe.load_merges(spark, path) == ml
    doc = json.loads(open(os.path.join(path, "tokenizer.json")).read())
    assert bpe.load_tokenizer(spark, path).merges == ml
    bpe.save_tokenizer(vocab, merges, path)                    # over the old one; no leftovers of the write
    assert bpe.load_tokenizer(spark, path).merges == ml and not glob.glob(os.path.join(path, "*.part"))
    assert len(doc["model"]["merges"]) == len(ml) and doc["model"]["vocab"]["<pad>"] == 0


def test_blocks_keep_the_pair_counts(spark):
    """After any batch the kept counts are those of the words as they are now."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c") for _ in range(40)) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    blocks = bpe.word_blocks(bpe.pretoken_counts(df))
    kept = {r["p"]: r["n"] for r in bpe.changes_of(blocks).collect()}
    a, b = bpe.BYTE_OFFSET + ord("a"), bpe.BYTE_OFFSET + ord("b")
    for batch in ([(a, a, 300), (a, b, 301)], [(300, 300, 302), (301, a, 303), (b, b, 304)], [(302, 300, 305)]):
        blocks = bpe.merged_blocks(blocks, batch)
        for r in bpe.changes_of(blocks).collect():
            kept[r["p"]] = kept.get(r["p"], 0) + r["n"]
        want = {}
        for r in blocks.collect():
            syms, weights = np.frombuffer(r["syms"], np.int32).astype(np.int64), np.frombuffer(r["weights"], np.int64)
            for p, n in zip(*bpe._pair_sums(syms, weights)) if len(syms) else ():
                want[int(p)] = want.get(int(p), 0) + int(n)
        assert {p: n for p, n in kept.items() if n} == want


def test_windows_of_bpe_ids_give_the_texts_back(spark):
    """docs -> ids -> windows -> batches -> padded -> labels -> texts; ids and index equal the tokenizers library's."""
    import tokenizers
    from corpusmill.operators import windows as W
    df = spark.read.parquet(f"{SF0001}/documents.parquet").limit(60)
    df = df.select("doc_id", "text").unionAll(spark.createDataFrame([(9001, ""), (9002, None), (9003, " \n\n x")], "doc_id bigint, text string"))
    tok = bpe.BpeTokenizer.train(df, bpe.FIRST_MERGE_ID + 300)
    batched = W.lm_labels(W.collate(W.batches(W.ordered_windows(df, tok, 32, 8), 4), 32))
    real = F.filter("labels", lambda x: x != tx.IGNORE_ID)
    back = W.unwindowed(batched.select("doc_id", "window_ix", "n_tokens", real.alias("input_ids")), 8)
    got = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(back, bpe.vocab_table(spark, tok.merges)).collect()}
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert got == {i: t for i, t in texts.items() if t}
    hf = tokenizers.Tokenizer.from_str(bpe.tokenizer_json(tok.merges))
    for r in tok.encode_df(df).collect():
        assert list(r["input_ids"]) == hf.encode(texts[r["doc_id"]] or "").ids
    index = W.window_index(tok.encode_df(df), 32, 8).orderBy("sample_id").collect()
    sizes = {i: len(hf.encode(t or "").ids) for i, t in texts.items()}
    want = [(i, k) for i in sorted(sizes) for k in range(0 if not sizes[i] else 1 if sizes[i] <= 32 else 1 + -(-(sizes[i] - 32) // 24))]
    assert [(r["doc_id"], r["window_ix"]) for r in index] == want and [r["sample_id"] for r in index] == list(range(len(want)))


@pytest.mark.parametrize("texts", CORPORA)
def test_few_segments_equal_sequential(spark, monkeypatch, texts):
    """Where the segments of the top pairs would be too many, fewer pairs are taken: more rounds, the same merges."""
    monkeypatch.setattr(bpe, "MAX_SEGMENTS", 16)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    _, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 12)
    got = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    assert got == sequential_bpe(texts, bpe.FIRST_MERGE_ID + 12)


def test_rounds_end_at_the_last_top_pair_only(spark, monkeypatch):
    """A round makes hundreds of merges, chains of new symbols and runs of one symbol included."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aaabcde") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    df = spark.createDataFrame([(i, " ".join(rng.choices(words, k=60))) for i in range(40)], "doc_id bigint, text string")
    rounds, apply = [], bpe.merged_blocks
    monkeypatch.setattr(bpe, "merged_blocks", lambda blocks, batch: (rounds.append(len(batch)), apply(blocks, batch))[1])
    _, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 500)
    got = [(r["left_id"], r["right_id"], r["new_id"]) for r in merges.orderBy("rank").collect()]
    counts = {r["word"]: r["n"] for r in bpe.pretoken_counts(df).collect()}
    assert got == indexed_bpe(counts, 500) and len(got) == 500
    assert len(rounds) <= 8


def test_rounds_have_as_many_tasks_as_the_words_need(spark, monkeypatch):
    """Whatever the session's number of shuffle partitions, which stays as it is; more words, more tasks, the same merges."""
    df = spark.createDataFrame([(i, " ".join(f"w{i * 7 % 31}x{k}" for k in range(20))) for i in range(40)], "doc_id bigint, text string")
    key, tasks, apply = "spark.sql.shuffle.partitions", [], bpe.merged_blocks
    monkeypatch.setattr(bpe, "merged_blocks", lambda blocks, batch: (tasks.append(blocks.rdd.getNumPartitions()), apply(blocks, batch))[1])
    old = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        cores, found = spark.sparkContext.defaultParallelism, []
        for words in (bpe.TASK_WORDS, 50):
            monkeypatch.setattr(bpe, "TASK_WORDS", words)
            _, merges = bpe.train_bpe(df, vocab_size=bpe.FIRST_MERGE_ID + 20)
            found.append([tuple(r) for r in merges.orderBy("rank").collect()])
            n = bpe.pretoken_counts(df).count()
            assert set(tasks) == {max(cores, -(-n // words))} and spark.conf.get(key) == "37"
            tasks.clear()
        assert found[0] == found[1] and len(found[0]) == 20 and -(-n // 50) > cores
    finally:
        spark.conf.set(key, old)
