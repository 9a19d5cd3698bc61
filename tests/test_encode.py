import os

import pytest
from rows import table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairmill.config import ChatTemplate
from pairmill.functions.tokens import CodepointTokenizer, FileTokenizer
from pairmill.operators import encode

L, M, EOS, PAD = 64, 16, 7, 9
BARE = ChatTemplate("", "")


def policy(prompt, answer, length=L, least=M, eos=EOS, pad=PAD):
    """The over-length policy, spelled out."""
    room = length - len(prompt)
    if room < least + 1:
        return None
    kept = list(answer[: room - 1]) + [eos]
    used = len(prompt) + len(kept)
    return (
        list(prompt) + kept + [pad] * (length - used),
        [1] * used + [0] * (length - used),
        [-100] * len(prompt) + kept + [-100] * (length - used),
    )


def encoded(spark, pairs, tokenizer=CodepointTokenizer(EOS, PAD), template=BARE, length=L):
    rows = [(i, p, a) for i, (p, a) in enumerate(pairs)]
    frame = table(spark, rows, "id int, instruction string, response string")
    result = encode.encode_sft(frame, tokenizer, length, M, template, keep=("id",))
    return {r["id"]: (r["input_ids"], r["attention_mask"], r["labels"]) for r in result.collect()}


@pytest.mark.parametrize(
    "prompt,answer,supervised,padded",
    [
        (10, 5, 6, L - 16), (L - 17, 16, 17, 0), (L - 17, 17, 17, 0), (L - 17, 500, 17, 0),
        (L - 16, 1, None, None), (L, 1, None, None), (L + 5, 1, None, None),
        (10, 0, 1, L - 11),
    ],
)
def test_boundaries(spark, prompt, answer, supervised, padded):
    got = encoded(spark, [("p" * prompt, "a" * answer)])
    if supervised is None:
        assert got == {}
        return
    ids, mask, labels = got[0]
    assert len(ids) == len(mask) == len(labels) == L
    span = [x for x in labels if x != -100]
    assert len(span) == supervised and span[-1] == EOS and mask.count(0) == padded


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("xyz", max_size=80), st.text("abc\U0001f600", max_size=90)),
                min_size=1, max_size=25))
def test_policy_on_random_pairs(spark, pairs):
    got = encoded(spark, pairs)
    for i, (p, a) in enumerate(pairs):
        want = policy([ord(c) for c in p], [ord(c) for c in a])
        assert got.get(i) == want


def test_padding_falls_back_to_the_end_token(spark):
    ids, _, _ = encoded(spark, [("p", "a")], CodepointTokenizer(EOS))[0]
    assert ids[-1] == EOS


def bpe_file(tmp_path):
    """A small vocabulary trained here and now."""
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.BPE())
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = trainers.BpeTrainer(
        vocab_size=400, special_tokens=["<end>", "<pad>", "<|im_end|>"],
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False,
    )
    tokenizer.train_from_iterator(["the cat sat on the mat", "the hat of the cat"] * 20, trainer)
    path = os.path.join(tmp_path, "tokenizer.json")
    tokenizer.save(path)
    return path, tokenizer


def test_tokenizer_file(spark, tmp_path):
    path, tokenizer = bpe_file(tmp_path)
    plugged = FileTokenizer(spark, path, "<end>", "<pad>")
    pairs = [("the cat " * n, "sat on the hat " * (n % 7)) for n in range(40)] + [("é\U0001f600", "")]
    template = ChatTemplate("<|im_end|>user\n", "\n")
    got = encoded(spark, pairs, plugged, template)
    for i, (p, a) in enumerate(pairs):
        def ids(text):
            return tokenizer.encode(text, add_special_tokens=False).ids
        want = policy(
            ids(f"<|im_end|>user\n{p}\n"), ids(a), eos=plugged.eos_id, pad=plugged.pad_id
        )
        assert got.get(i) == want
    words = table(spark, [(p,) for p, _ in pairs], "t string")
    for text, tokens in words.select("t", plugged.ids(F.col("t"))).collect():
        assert tokens == tokenizer.encode(text, add_special_tokens=False).ids


def test_each_text_is_tokenized_once(spark, tmp_path):
    plugged = FileTokenizer(spark, bpe_file(tmp_path)[0], "<end>")
    frame = table(spark, [("p", "a")], "instruction string, response string")
    plan = encode.encode_sft(frame, plugged, L)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_code_points_need_no_python(spark):
    frame = table(spark, [("p", "a")], "instruction string, response string")
    result = encode.encode_sft(frame, CodepointTokenizer(), L)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
