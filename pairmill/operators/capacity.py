"""Memory accounting of serving engines over tables of configurations and observed lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Structure and weight sizes of the known models.
MODELS = [
    ("qwen3-8b", 36, 8, 128, 16_381_470_720),
    ("qwen2.5-7b", 28, 4, 128, 15_231_233_024),
    ("qwen2.5-0.5b", 24, 2, 64, 988_000_000),
]
MODEL_SCHEMA = "model string, layers int, kv_heads int, head_dim int, weight_bytes bigint"
AVERAGE_LENGTHS = (512, 1024, 2048, 4096)
HEADROOM_LIMIT = 20


def known_models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODELS, MODEL_SCHEMA)


def capacity_accounting(
    configs: DataFrame, models: DataFrame, dtype_bytes: int = 2
) -> DataFrame:
    """Key/value bytes per token, the pool left by the weights, and the tokens that fit in it.

    ``configs`` holds model, card_gb, gpu_memory_utilization, tensor_parallel_size and
    max_model_len besides whatever identifies a row. Heads are those of keys and values, not of
    attention. Reserved and weight bytes and the bytes of one full sequence are kept as evidence.
    """
    per_token = (
        F.lit(2).cast("bigint") * F.col("layers") * F.col("kv_heads") * F.col("head_dim")
        * dtype_bytes
    )
    memory = F.col("card_gb").cast("double") * F.lit(1e9) * F.col("tensor_parallel_size")
    return (
        configs.join(models, "model")
        .withColumn("kv_bytes_per_token", per_token)
        .withColumn("reserved_bytes", memory * F.col("gpu_memory_utilization"))
        .withColumn("kv_pool_bytes", F.col("reserved_bytes") - F.col("weight_bytes"))
        .withColumn("sequence_bytes", F.col("kv_bytes_per_token") * F.col("max_model_len"))
        .withColumn(
            "token_budget",
            F.when(
                F.col("kv_pool_bytes") > 0, F.col("kv_pool_bytes") / F.col("kv_bytes_per_token")
            ).otherwise(F.lit(0.0)),
        )
        .withColumn("worst_case_sequences", F.col("token_budget") / F.col("max_model_len"))
        .drop("layers", "kv_heads", "head_dim")
    )


def capacity_by_length(accounted: DataFrame, lengths: tuple = AVERAGE_LENGTHS) -> DataFrame:
    """Sequences that fit at each candidate average length."""
    at = F.explode(F.array(*[F.lit(n) for n in lengths])).alias("average_length")
    return accounted.drop("average_length").select("*", at).withColumn(
        "sequences", F.floor(F.col("token_budget") / F.col("average_length"))
    )


def observed_lengths(tokens: DataFrame, by: tuple, length: str = "tokens") -> DataFrame:
    """Rows, mean and greatest sequence length per group."""
    return tokens.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sequences_seen"),
        F.avg(length).alias("average_length"),
        F.max(length).alias("longest"),
    )


def capacity_findings(accounted: DataFrame) -> DataFrame:
    """Adds the codes of what is wrong with each configuration, in a fixed order, and the ratio of
    worst-case sequences to the target.

    Over-subscription and too much headroom exclude each other and need a target and a budget.
    """
    target, most = F.col("target_ongoing_requests"), F.col("max_ongoing_requests")
    worst = F.col("worst_case_sequences")
    judged = (target != 0) & (F.col("token_budget") != 0)
    load = (
        F.when(judged & (target > worst), "oversubscribed")
        .when(judged & (worst / F.when(target != 0, target) > HEADROOM_LIMIT), "too_conservative")
    )
    findings = F.array_compact(
        F.array(
            F.when(F.col("kv_pool_bytes") <= 0, "weights_exceed_memory"),
            load,
            F.when((most != 0) & (target != 0) & (most <= target), "no_buffer"),
        )
    )
    ratio = F.when(judged, worst / F.when(target != 0, target))
    return accounted.withColumn("findings", findings).withColumn("target_ratio", ratio)
