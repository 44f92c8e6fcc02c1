from corpusmill.operators import encode, sft


def convs(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Add 2 and 2"), (1, 2, "assistant", "4"),
            (2, 0, "user", "Say hi"), (2, 1, "assistant", "hi"), (2, 2, "user", "no reply"),
            (3, 0, "user", "Say hi"), (3, 1, "assistant", "hi"),
            (4, 0, "user", "   "), (4, 1, "assistant", "empty instruction"),
            (5, 0, "user", "empty output"), (5, 1, "assistant", "")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_pairs_filter_prompt(spark):
    p = {(r["conv_id"], r["turn"]): r for r in sft.sft_pairs(convs(spark)).collect()}
    assert set(p) == {(1, 1), (2, 0), (3, 0), (4, 0), (5, 0)}
    assert p[(1, 1)]["input"] == "Be brief." and p[(2, 0)]["input"] == ""
    f = sft.sft_filter(sft.sft_pairs(convs(spark)))
    assert sorted((r["conv_id"], r["turn"]) for r in f.collect()) == [(1, 1), (2, 0)]
    pr = {r["conv_id"]: r["prompt"] for r in sft.sft_prompt(f).collect()}
    assert "### Input:\nBe brief." in pr[1] and "### Input" not in pr[2]
    assert pr[2].endswith("### Instruction:\nSay hi\n\n### Response:\n")


def test_encode_loss_mask_and_cut(spark):
    f = sft.sft_prompt(sft.sft_filter(sft.sft_pairs(convs(spark))))
    vocab = spark.createDataFrame([(3, "hi", 1), (4, "4", 1)], "token_id int, word string, n bigint")
    e = {r["conv_id"]: r for r in sft.sft_encode(f, encode.WordTokenizer(vocab), max_seq_length=64).collect()}
    r = e[2]
    assert list(r["labels"])[: r["prompt_tokens"]] == [-100] * r["prompt_tokens"]
    assert list(r["labels"])[r["prompt_tokens"]:] == [3, 2]
    assert list(r["input_ids"])[-2:] == [3, 2]
    short = sft.sft_encode(f, encode.WordTokenizer(vocab), max_seq_length=10).collect()
    assert short == []        # prompts longer than L leave no response token: dropped
    b = sft.sft_batches(sft.sft_encode(f, encode.WordTokenizer(vocab), max_seq_length=64), 2, 64).collect()
    assert sorted(x["sample_id"] for x in b) == [0, 1]
    assert all(len(x["labels"]) == 64 and len(x["input_ids"]) == 64 for x in b)
