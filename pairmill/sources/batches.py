"""Batch files with an index, so that a worker goes on anywhere without reading what it has had.

The index has one row per batch and file: where in the file the batch begins and how many of its rows are
there. It is made by the tasks that read the files' narrow columns, and lies in a folder that readers of
the batches do not look into.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX = "_index"
ENTRY = (
    "epoch int, shard int, batch bigint, file string, first_row bigint, rows bigint, first_pos bigint"
)


def index_batches(spark: SparkSession, output: str) -> None:
    """Writes the index of batch files partitioned by epoch and shard, sorted by batch and pos."""
    placed = spark.read.parquet(output).select(
        F.col("epoch").cast("int").alias("epoch"), F.col("shard").cast("int").alias("shard"),
        F.col("batch").cast("bigint").alias("batch"), F.col("pos").cast("bigint").alias("pos"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    entries = placed.groupBy("epoch", "shard", "batch", "file").agg(
        F.min("row").alias("first_row"), F.count(F.lit(1)).alias("rows"),
        F.min("pos").alias("first_pos"),
    )
    entries.sortWithinPartitions("epoch", "shard", "batch", "first_pos").write.mode(
        "errorifexists"
    ).partitionBy("epoch", "shard").parquet(f"{output}/{INDEX}")


def read_index(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(f"{output}/{INDEX}")


def remaining(
    spark: SparkSession, output: str, epoch: int, shard: int, batch: int = 0
) -> DataFrame:
    """(file, first_row, rows, batches) of what a worker has still to read from ``batch`` on, one row
    per file; files follow each other by their first batch and position."""
    entries = read_index(spark, output).where(
        (F.col("epoch") == epoch) & (F.col("shard") == shard) & (F.col("batch") >= batch)
    )
    return entries.groupBy("file").agg(
        F.min(F.struct("batch", "first_pos")).alias("begins"), F.min("first_row").alias("first_row"),
        F.sum("rows").alias("rows"), F.count_distinct("batch").alias("batches"),
    )


def resume(
    spark: SparkSession, output: str, epoch: int, shard: int, batch: int = 0
) -> DataFrame:
    """The rows of a shard from a batch on, in order.

    Only files that hold such batches are opened, as the index tells, and in them only row groups:
    rows lie by batch in a file, so the comparison reaches the statistics of the scan.
    """
    # As many as one worker has files in one epoch.
    files = [r["file"] for r in remaining(spark, output, epoch, shard, batch).select("file").collect()]
    folder = f"{output}/epoch={epoch}/shard={shard}"
    rows = spark.read.option("basePath", output)
    if not files:
        return rows.parquet(folder).where(F.lit(False))
    found = rows.parquet(*[f"{folder}/{name}" for name in files])
    return found.where(F.col("batch") >= batch).orderBy("batch", "pos")
