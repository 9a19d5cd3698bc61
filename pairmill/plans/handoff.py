"""A data version to batches for training, and a trained checkpoint back to a version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.config import TrainConfig
from pairmill.errors import JobFailed
from pairmill.operators.training import (
    BUCKET_ROWS,
    batch_plan,
    bucket_digits_for,
    checkpoint_select,
    cut_padding,
    epoch_loss,
    restore_padding,
    supervision_audit,
)
from pairmill.session import SHUFFLE_BYTES
from pairmill.sinks import publish as sink
from pairmill.sources import versions
from pairmill.sources.batches import index_batches

PROVENANCE = (
    "run_id string, base_model string, data_version string, data_rows bigint, "
    "num_workers bigint, parallel_strategy string, epochs bigint, batch_size bigint, lr double, "
    "seed bigint, checkpoint_selection string, metrics map<string,double>"
)


def write_batches(spark: SparkSession, config: TrainConfig, output: str) -> str:
    """Lays out the shuffled batches of every epoch and shard; returns the data version read.

    Files are partitioned by epoch and shard, in batch order, so a worker reads only its own.
    Rows travel once, without their padding, into ranges of the shuffled order; ranges and the buckets
    they consist of are sized by the tokens in them. An index of the batches lies beside the files.
    """
    version = versions.resolve_data(spark, config.tokenized_dir)
    rows = versions.read_train(spark, version)
    audit = supervision_audit(rows).first()
    if audit["unsupervised_rows"]:
        raise JobFailed(f"{version} holds rows without a supervised token")
    attended = rows.agg(F.sum(F.size(F.filter("attention_mask", lambda m: m == 1)))).first()[0]
    # Two arrays of eight-byte numbers travel.
    travelling = 16 * (attended or 0)
    partitions = 1 + travelling * config.epochs // SHUFFLE_BYTES
    # Enough buckets that ranges come out even: a range has some eight of them.
    buckets = max(audit["rows"] // BUCKET_ROWS, 8 * travelling // SHUFFLE_BYTES)
    plan = batch_plan(
        cut_padding(rows), epochs=config.epochs, num_workers=config.num_workers,
        batch_size=config.batch_size, seed=config.seed, partitions=partitions,
        bucket_digits=bucket_digits_for(buckets, 1),
    )
    laid_out = restore_padding(plan.sortWithinPartitions("epoch", "shard", "batch", "pos"))
    laid_out.select(
        "epoch", "shard", "batch", "pos", *rows.columns
    ).write.mode("errorifexists").partitionBy("epoch", "shard").parquet(output)
    index_batches(spark, output)
    return version


def checked_epoch_loss(steps: DataFrame, keys: tuple = ("run_id", "epoch")) -> DataFrame:
    """Epoch losses; fails when some epoch has no valid step at all."""
    losses = epoch_loss(steps, keys)
    empty = losses.where(~F.col("valid")).orderBy(*keys).first()
    if empty:
        raise JobFailed(f"no finite loss in {dict(zip(keys, empty))}: are its labels all masked?")
    return losses


def export_run(
    spark: SparkSession,
    config: TrainConfig,
    checkpoints: DataFrame,
    data_version: str,
    metrics: dict[str, float],
) -> tuple[str, str]:
    """Records a run's chosen checkpoint as a new model version and publishes it.

    Returns the version and the checkpoint whose files belong into it; copying weights is the
    caller's business.
    """
    chosen = checkpoint_select(checkpoints.where(F.col("run_id") == config.run_id)).first()
    if chosen is None:
        raise JobFailed("training left no checkpoint")
    version = sink.claim_version(spark, config.model_root, f"sft-{config.run_id}")
    provenance = {
        "run_id": config.run_id,
        "base_model": config.base_model,
        "data_version": data_version,
        "data_rows": versions.read_train(spark, data_version).count(),
        "num_workers": config.num_workers,
        "parallel_strategy": config.parallel_strategy,
        "epochs": config.epochs,
        "batch_size": config.batch_size,
        "lr": config.lr,
        "seed": config.seed,
        "checkpoint_selection": chosen["selection"],
        "metrics": metrics,
    }
    sink.write_record(spark, provenance, PROVENANCE, f"{version}/provenance")
    sink.publish(spark, version)
    return version, chosen["checkpoint"]


def read_provenance(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(PROVENANCE).json(f"{version}/provenance")
