"""Inputs of the registered queries, derived by Spark from the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.sources.raw import pairs_from_conversations

# Fixed value: a text of characters that all count as blank.
BLANK_TEXT = "  \t"
STREAM_EPOCH_US = 1_704_067_200_000_000
PIECE_CHARS = 40


def vocabulary_file() -> str:
    """A byte-level vocabulary of the box."""
    return "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_from_conversations(table(spark, sf_dir, "conversations"))


def thinned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of conversations without system turns and without every seventh turn number, which
    leaves gaps in the numbers."""
    turns = table(spark, sf_dir, "conversations")
    return pairs_from_conversations(
        turns.where((F.col("role") != "system") & ((F.col("conv_id") + F.col("turn")) % 7 != 2))
    )


def gappy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the answers of some conversations missing or blank."""
    spoilt = (
        F.when(F.col("conv_id") % 10 == 3, F.lit(None).cast("string"))
        .when(F.col("conv_id") % 10 == 7, BLANK_TEXT)
        .otherwise(F.col("response"))
    )
    return pairs(spark, sf_dir).withColumn("response", spoilt)


def repeated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy pairs, each three times."""
    return gappy_pairs(spark, sf_dir).withColumn("repeat", F.explode(F.expr("sequence(0, 2)")))


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pairs of language and text, each three times."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("instruction"), F.col("text").alias("response"), "source",
        F.explode(F.expr("sequence(0, 2)")).alias("repeat"),
    )


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations as good as the reference answer, but missing or blank in places."""
    return gappy_pairs(spark, sf_dir).select(
        "conv_id", "turn", "instruction",
        F.col("response").alias("reference"), F.col("response").alias("generated"),
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion bodies of every turn: good, with an error, without choices or with text behind
    them, blank, or unfinished."""
    fault = F.col("conv_id") % 6
    content = F.when(fault == 4, BLANK_TEXT).otherwise(F.col("text"))
    choice = F.struct(
        F.struct(content.alias("content")).alias("message"),
        F.when(fault != 5, "stop").alias("finish_reason"),
    )
    body = (
        F.when(fault == 2, '{"error":null,"choices":[]}')
        .when((fault == 3) & (F.col("turn") % 2 == 1), '{"choices":[]},0]')
        .when(fault == 3, '{"choices":[]}')
        .otherwise(F.to_json(F.struct(F.array(choice).alias("choices"))))
    )
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", body.alias("body"))


def model_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array(
        F.struct(F.concat(F.lit("m-"), F.col("conv_id") % 5).alias("id")),
        F.struct(F.concat(F.lit("m-"), F.col("turn")).alias("id")),
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.to_json(F.struct(ids.alias("data"))).alias("body")
    )


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines of every turn, with a fault by conversation.

    1 no end marker, 2 an error event midway, 3 all lines at one instant, 4 frames without
    content, 5 a payload midway that is broken or has text behind it, 6 a failed transfer.
    """
    turns = table(spark, sf_dir, "conversations")
    numbered = turns.select(
        "conv_id", "turn", "text",
        (F.col("conv_id") % 7).alias("fault"),
        F.ceil(F.length("text") / PIECE_CHARS).alias("n"),
    ).withColumn("seq", F.explode(F.expr("sequence(0L, n + 1)")))
    numbered = numbered.where((F.col("fault") != 1) | (F.col("seq") != F.col("n")))
    piece = F.expr(f"substring(text, int(seq) * {PIECE_CHARS} + 1, {PIECE_CHARS})")
    delta = F.struct(F.struct(piece.alias("content")).alias("delta"))
    midway = F.col("seq") == F.expr("n div 2")
    line = (
        F.when(F.col("seq") == F.col("n") + 1, F.lit(None).cast("string"))
        .when(F.col("seq") == F.col("n"), "data: [DONE]")
        .when((F.col("fault") == 2) & midway, 'data: {"error":{"message":"overloaded"}}')
        .when(
            (F.col("fault") == 5) & midway,
            F.when(F.col("turn") % 2 == 0, 'data: {"choices":[').otherwise('data: {"choices":[]},0]'),
        )
        .when(F.col("fault") == 4, 'data: {"choices":[{"delta":{"role":"assistant"}}]}')
        .otherwise(
            F.concat(F.lit("data: "), F.to_json(F.struct(F.array(delta).alias("choices"))))
        )
    )
    offset = F.when(F.col("fault") == 3, 0).otherwise(F.col("seq") * 50_000)
    arrived = F.timestamp_micros(
        F.lit(STREAM_EPOCH_US) + F.col("conv_id") * 60_000_000 + F.col("turn") * 10_000_000 + offset
    )
    return numbered.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
            "request_id"
        ),
        "seq",
        arrived.alias("arrived_at"),
        line.alias("line"),
        F.when(line.isNull(), F.when(F.col("fault") == 6, 28).otherwise(0)).alias("transfer_rc"),
    )


def paused_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines, some requests of which pause for ten minutes before their fourth line."""
    number = F.substring_index("request_id", ":", 1).cast("bigint")
    late = (number % 5 == 0) & (F.col("seq") > 2)
    return stream_lines(spark, sf_dir).withColumn(
        "arrived_at",
        F.when(late, F.col("arrived_at") + F.expr("INTERVAL 10 MINUTES")).otherwise(F.col("arrived_at")),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job states polled over time: a user's events, read as states of one job."""
    kind = F.col("event_type")
    deploy = (
        F.when(kind == "signup", "Initializing")
        .when(kind.isin("view", "click"), "Running")
        .otherwise("Complete")
    )
    job = (
        F.when(kind == "signup", "")
        .when(kind.isin("view", "click"), "RUNNING")
        .when(kind == "purchase", "SUCCEEDED")
        .otherwise("FAILED")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job"), F.col("ts").alias("observed_at"),
        F.col("event_id").alias("seq"), deploy.alias("deploy_status"), job.alias("job_status"),
        F.col("event_type").alias("reason"), F.col("props").alias("message"),
    )


def step_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events, read as steps of one run; errors have no finite loss."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.dayofmonth("ts").alias("epoch"),
        F.col("event_id").alias("step"),
        F.lit(0).alias("rank"),
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("value")).alias("loss"),
    )


def engine_configs(documents: DataFrame, models: list[str]) -> DataFrame:
    """One engine configuration per source, model and card, sized by the source's documents."""
    from pairmill.operators.capacity import observed_lengths

    lengths = documents.select("source", F.length("text").alias("tokens"))
    seen = observed_lengths(lengths, ("source",))
    return (
        seen.select(
            "source", "average_length",
            F.col("longest").alias("max_model_len"),
            F.col("sequences_seen").alias("target_ongoing_requests"),
            F.when(F.col("longest") % 2 == 0, F.col("sequences_seen"))
            .otherwise(F.col("sequences_seen") * 2).alias("max_ongoing_requests"),
            F.lit(0.85).alias("gpu_memory_utilization"),
            F.lit(1).alias("tensor_parallel_size"),
            F.explode(F.array(*[F.lit(m) for m in models])).alias("model"),
        )
        .select("*", F.explode(F.array(F.lit(16), F.lit(24), F.lit(80))).alias("card_gb"))
    )
