"""Generation requests, batch generation through a pluggable model, request bodies."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.config import ChatTemplate
from pairmill.functions.text import render_prompt
from pairmill.session import ship_package

# Called once per Python worker; returns the function that answers a batch of prompts with
# texts, or None where the model returned nothing.
MakePredict = Callable[[], Callable[[np.ndarray], np.ndarray]]

# Greedy decoding, the pipeline rather than the engine turning ids into text.
SAMPLING = {"temperature": 0.0, "max_tokens": 256, "detokenize": False}


def user_message(instruction: Column) -> Column:
    return F.array(
        F.struct(F.lit("user").alias("role"), instruction.alias("content"))
    )


def generation_requests(rows: DataFrame, max_tokens: int = 256) -> DataFrame:
    """Adds ``messages`` and ``sampling_params`` for greedy decoding."""
    values = {**SAMPLING, "max_tokens": max_tokens}
    parameters = F.struct(*[F.lit(value).alias(name) for name, value in values.items()])
    return rows.withColumn("messages", user_message(F.col("instruction"))).withColumn(
        "sampling_params", parameters
    )


def last_user_prompt(template: ChatTemplate = ChatTemplate()) -> Column:
    return render_prompt(F.element_at("messages", -1)["content"], template)


def batch_generate(
    rows: DataFrame,
    make_predict: MakePredict,
    batch_size: int = 32,
    concurrency: int = 0,
    max_tokens: int = 256,
    template: ChatTemplate = ChatTemplate(),
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    keep: tuple = (),
) -> DataFrame:
    """instruction, reference and generated for every row.

    The model is loaded once per Python worker and asked in batches. ``concurrency`` fixes the
    number of tasks, one model each; 0 keeps the partitioning of the input. ``preprocess`` adds
    ``messages`` to the rows and may be swapped, which turns the job into data synthesis. The
    model call is marked non-deterministic, so no filter placed behind it runs it twice.
    """
    ship_package(rows.sparkSession)
    if "response" not in rows.columns:
        rows = rows.withColumn("response", F.lit(""))
    asked = (preprocess or (lambda r: generation_requests(r, max_tokens)))(rows)
    asked = asked.select(
        *keep, "instruction", "response", last_user_prompt(template).alias("_prompt")
    )
    if concurrency:
        asked = asked.repartition(concurrency)
    model = predict_batch_udf(
        make_predict, return_type=T.StringType(), batch_size=batch_size
    ).asNondeterministic()
    return asked.select(
        *keep,
        "instruction",
        F.col("response").alias("reference"),
        model(F.col("_prompt")).alias("generated"),
    )


def request_bodies(
    rows: DataFrame, model: str, max_tokens: int = 128, stream: bool = False,
    prompt: str = "instruction",
) -> DataFrame:
    """Adds ``body``, a chat completion request in JSON with every character escaped properly."""
    request = F.struct(
        F.lit(model).alias("model"),
        user_message(F.col(prompt)).alias("messages"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(0).alias("temperature"),
        F.lit(stream).alias("stream"),
    )
    return rows.withColumn("body", F.to_json(request))


def context_budget(
    prompt_tokens: DataFrame, max_tokens: int, max_model_len: int, by: tuple = ()
) -> DataFrame:
    """Requests, the longest one, and how many do not fit the context with their output."""
    needed = F.col("prompt_tokens") + max_tokens
    return prompt_tokens.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.max(needed).alias("longest"),
        F.count_if(needed > max_model_len).alias("over_budget"),
    )
