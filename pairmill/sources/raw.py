"""Raw instruction/response pairs, and where they may come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.functions import variants as V
from pairmill.operators.neighbours import with_previous
from pairmill.sources import files

RAW_SCHEMA = T.StructType(
    [T.StructField("instruction", T.StringType()), T.StructField("response", T.StringType())]
)

# Eight pairs of our own, only for trying the job without data.
DEMO_PAIRS = [
    ("What does a shuffle do?", "It moves rows with equal keys to the same task."),
    ("When is a broadcast join safe?", "When one side is small and its size has been checked."),
    ("What is partial aggregation?", "Combining rows of a key before they are moved."),
    ("Why write to a new folder per run?", "So that nobody reads a half-replaced data set."),
    ("What is a holdout?", "Rows kept away from training to judge the result."),
    ("Why keep the end token?", "Without it a model never learns where answers stop."),
    ("What does a watermark bound?", "How long a stream waits for late rows, hence its state."),
    ("Why sort by a content hash?", "The order then depends on the data alone."),
]
DEMO_REPEATS = 16


def read_pairs(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    extra: T.StructType | None = None,
    strict: bool = False,
) -> DataFrame:
    """Pairs from a folder of JSON lines or parquet; a malformed line fails the job.

    By default both fields are read as text. ``strict`` looks at the JSON type first and makes
    null of what Python treats as false (0, false, [], {}), so that such rows are dropped later.
    """
    schema = T.StructType(RAW_SCHEMA.fields + (extra.fields if extra else []))
    if file_format == "parquet":
        return spark.read.schema(schema).parquet(path)
    if not strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = spark.read.option("singleVariantColumn", "row").option("mode", "FAILFAST").json(path)
    fields = [_truthy_text(f.name) for f in RAW_SCHEMA.fields]
    others = [V.get(F.col("row"), f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
              for f in (extra.fields if extra else [])]
    return rows.select(*fields, *others)


def _truthy_text(name: str) -> Column:
    value = V.get(F.col("row"), f"$.{name}")
    text = F.when(V.is_kind(value, "BOOLEAN"), "True").otherwise(V.get(value, "$", "string"))
    return F.when(V.truthy(value), text).alias(name)


def has_input(spark: SparkSession, path: str, file_format: str = "json") -> bool:
    """Whether a raw folder holds files of the format: .jsonl, .json or compressed, or .parquet."""
    return files.any_match(spark, f"{path.rstrip('/')}/*.{file_format}*")


def demo_pairs(spark: SparkSession) -> DataFrame:
    pairs = spark.createDataFrame(DEMO_PAIRS, RAW_SCHEMA)
    repeats = F.explode(F.sequence(F.lit(0), F.lit(DEMO_REPEATS - 1))).alias("repeat")
    return pairs.select("instruction", "response", repeats)


def seed_demo_data(spark: SparkSession, path: str, file_format: str = "json") -> None:
    """Writes the demo pairs into a raw folder that has no file of the format."""
    demo_pairs(spark).coalesce(1).write.mode("append").format(file_format).save(path)


# Turn numbers in a chunk, and in a chunk of chunks.
CHUNK_TURNS, SPAN_TURNS = 64, 64 * 1024


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """A user turn and the assistant turn that follows next, as one pair, whatever the numbers.

    The table is read and shuffled once; however long one conversation is, its turns spread over
    tasks.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")

    def answered(rows: DataFrame) -> DataFrame:
        return rows.where((F.col("role") == "user") & (F.col("previous.role") == "assistant"))

    followed = with_previous(
        turns, "conv_id", ["turn"],
        [F.expr(f"turn div {CHUNK_TURNS}"), F.expr(f"turn div {SPAN_TURNS}")],
        F.struct("role", "text"), backwards=True, wanted=answered,
    )
    return followed.select(
        "conv_id", "turn", F.col("text").alias("instruction"),
        F.col("previous.text").alias("response"),
    )
