"""Tokenizers: they turn (prompt, answer) text columns into two id arrays and nothing more."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pairmill.functions.text import codepoints
from pairmill.session import ship_package
from pairmill.sources import files

TOKEN_PAIR = "prompt_ids array<bigint>, answer_ids array<bigint>"


@dataclass(frozen=True)
class CodepointTokenizer:
    """One token per Unicode code point, entirely in built-in expressions."""

    eos_id: int = 0x110000
    pad_id: int | None = None

    def count(self, text: Column) -> Column:
        """Number of tokens, without making them."""
        return F.length(text)

    def ids(self, text: Column) -> Column:
        return codepoints(text)

    def encode_pair(self, prompt: Column, answer: Column) -> Column:
        return F.struct(self.ids(prompt).alias("prompt_ids"), self.ids(answer).alias("answer_ids"))


class FileTokenizer:
    """A ``tokenizer.json`` of the tokenizers library, loaded once per task over Arrow batches.

    An optional plug-in. The file is a fixed vocabulary that does not grow with the data, so it
    is broadcast.

    Its UDFs are marked non-deterministic so that a later filter on the number of ids is not
    pushed below them, which would tokenize every text twice.
    """

    def __init__(
        self, spark: SparkSession, path: str, eos_token: str, pad_token: str | None = None
    ):
        definition = files.read_text(spark, path)
        ship_package(spark)
        self._definition = spark.sparkContext.broadcast(definition)
        tokenizer = _load(definition)
        self.eos_id = tokenizer.token_to_id(eos_token)
        if self.eos_id is None:
            raise ValueError(f"{path} has no token {eos_token}")
        self.pad_id = tokenizer.token_to_id(pad_token) if pad_token else None

    def ids(self, text: Column) -> Column:
        return self._ids(text)

    def encode_pair(self, prompt: Column, answer: Column) -> Column:
        return self._pair(prompt, answer)

    @cached_property
    def _ids(self):
        shared = self._definition

        @F.pandas_udf("array<bigint>")
        def token_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenizer = _load(shared.value)
            for texts in batches:
                yield pd.Series(_encode(tokenizer, texts))

        return token_ids.asNondeterministic()

    @cached_property
    def _pair(self):
        shared = self._definition

        @F.pandas_udf(TOKEN_PAIR)
        def token_pair(
            batches: Iterator[tuple[pd.Series, pd.Series]],
        ) -> Iterator[pd.DataFrame]:
            tokenizer = _load(shared.value)
            for prompts, answers in batches:
                yield pd.DataFrame(
                    {
                        "prompt_ids": _encode(tokenizer, prompts),
                        "answer_ids": _encode(tokenizer, answers),
                    }
                )

        return token_pair.asNondeterministic()


def _load(definition: str):
    # Tasks are the unit of parallelism; a task must not take the cores of others.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode(tokenizer, texts) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
