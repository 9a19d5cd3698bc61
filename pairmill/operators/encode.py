"""Fixed-length training rows with an explicit policy for texts that are too long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.config import IGNORED_LABEL, ChatTemplate
from pairmill.functions.text import render_prompt


def tokenize_pairs(
    pairs: DataFrame, tokenizer, template: ChatTemplate = ChatTemplate(), keep: tuple = ()
) -> DataFrame:
    """``keep`` plus prompt_ids and answer_ids; no special tokens are added."""
    texts = pairs.select(
        *keep,
        render_prompt(F.col("instruction").cast("string"), template).alias("_prompt"),
        F.col("response").cast("string").alias("_answer"),
    )
    ids = texts.select(
        *keep, tokenizer.encode_pair(F.col("_prompt"), F.col("_answer")).alias("_ids")
    )
    return ids.select(*keep, "_ids.prompt_ids", "_ids.answer_ids")


def has_budget(prompt_tokens: Column, max_len: int, min_answer_tokens: int) -> Column:
    """Whether the prompt leaves room for the shortest allowed answer and its end token."""
    return F.lit(max_len) - prompt_tokens >= min_answer_tokens + 1


def is_truncated(max_len: int) -> Column:
    return F.size("answer_ids") > F.lit(max_len) - F.size("prompt_ids") - 1


def overlength_split(tokens: DataFrame, max_len: int, min_answer_tokens: int) -> DataFrame:
    """Adds prompt and answer sizes and what the policy does with the row."""
    policy = (
        F.when(~has_budget(F.size("prompt_ids"), max_len, min_answer_tokens), "rejected")
        .when(is_truncated(max_len), "truncated")
        .otherwise("whole")
    )
    return tokens.select(
        *[c for c in tokens.columns if c not in ("prompt_ids", "answer_ids")],
        F.size("prompt_ids").cast("bigint").alias("prompt_tokens"),
        F.size("answer_ids").cast("bigint").alias("answer_tokens"),
        policy.alias("policy"),
    )


def pad_tokens(
    tokens: DataFrame, eos_id: int, pad_id: int | None, max_len: int, keep: tuple = ()
) -> DataFrame:
    """input_ids, attention_mask and labels, each of exactly ``max_len`` elements.

    Prompts are never cut and must leave room; answers are cut to what fits but always end in
    ``eos_id``. Padding falls back to the end token. Labels are ignored over prompt and padding.
    """
    pad = eos_id if pad_id is None else pad_id
    answered = tokens.select(
        *keep,
        "prompt_ids",
        F.concat(
            F.slice(
                "answer_ids",
                F.lit(1),
                F.least(F.size("answer_ids"), F.lit(max_len - 1) - F.size("prompt_ids")),
            ),
            F.array(F.lit(eos_id).cast("bigint")),
        ).alias("_answer"),
    )
    used = F.size("prompt_ids") + F.size("_answer")

    def fill(value: int, count: Column) -> Column:
        return F.array_repeat(F.lit(value).cast("bigint"), count)

    return answered.select(
        *keep,
        F.concat("prompt_ids", "_answer", fill(pad, max_len - used)).alias("input_ids"),
        F.concat(fill(1, used), fill(0, max_len - used)).alias("attention_mask"),
        F.concat(
            fill(IGNORED_LABEL, F.size("prompt_ids")), "_answer",
            fill(IGNORED_LABEL, max_len - used),
        ).alias("labels"),
    )


def encode_sft(
    pairs: DataFrame,
    tokenizer,
    max_len: int = 1024,
    min_answer_tokens: int = 16,
    template: ChatTemplate = ChatTemplate(),
    keep: tuple = (),
) -> DataFrame:
    """Pairs to fixed-length training rows; ``keep`` names lineage columns to carry along.

    A row whose prompt leaves too little room is dropped, before it is tokenized when the
    tokenizer can count without tokenizing.
    """
    if hasattr(tokenizer, "count"):
        prompt = render_prompt(F.col("instruction").cast("string"), template)
        fitting = pairs.where(has_budget(tokenizer.count(prompt), max_len, min_answer_tokens))
        tokens = tokenize_pairs(fitting, tokenizer, template, keep)
    else:
        tokens = tokenize_pairs(pairs, tokenizer, template, keep).where(
            has_budget(F.size("prompt_ids"), max_len, min_answer_tokens)
        )
    return pad_tokens(tokens, tokenizer.eos_id, tokenizer.pad_id, max_len, keep)
