"""Tables around training: shards and batches, supervision, losses, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.config import IGNORED_LABEL

# Rows of a bucket, which one task sorts, and the most digest digits that make buckets.
BUCKET_ROWS = 100_000
MOST_DIGITS = 8
# Offsets up to so many are broadcast; more are joined where the rows lie after their one shuffle.
BROADCAST_OFFSETS = 1_000_000


def bucket_digits_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Leading hex digits of a digest that leave about ``bucket_rows`` rows or fewer in a bucket."""
    digits = 1
    while digits < MOST_DIGITS and rows > bucket_rows * 16**digits:
        digits += 1
    return digits


def bucket_offsets(counts: DataFrame, digits: int) -> DataFrame:
    """(epoch, _bucket, _offset, _total) from the rows per bucket: a prefix sum in two levels.

    Buckets are added up by the first half of their digits; sums run over those, and inside each of them
    over the second half. So no task orders more than the square root of all offsets of an epoch.
    """
    head = F.substring("_bucket", 1, max(1, digits // 2)).alias("_head")
    leaves = counts.select("*", head)
    heads = leaves.groupBy("epoch", "_head").agg(F.sum("_n").alias("_n"))
    before = Window.orderBy("_head").partitionBy("epoch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    heads = heads.select(
        "epoch", "_head", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above"),
        F.sum("_n").over(Window.partitionBy("epoch")).alias("_total"),
    )
    inside = Window.partitionBy("epoch", "_head").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = leaves.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return within.join(heads, ["epoch", "_head"]).select(
        "epoch", "_bucket", (F.col("_above") + F.col("_within")).alias("_offset"), "_total"
    )


def cut_padding(rows: DataFrame) -> DataFrame:
    """Fixed-length rows without the padding behind the last attended token."""
    used = F.size(F.filter("attention_mask", lambda m: m == 1))
    short = {c: F.slice(c, F.lit(1), used) for c in ("input_ids", "labels")}
    return rows.withColumns(
        short
        | {"_pad": F.element_at("input_ids", -1), "_length": F.size("input_ids")}
    ).drop("attention_mask")


def restore_padding(rows: DataFrame) -> DataFrame:
    """The rows that ``cut_padding`` was given."""
    used = F.size("input_ids")
    missing = F.col("_length") - used

    def fill(value: Column) -> Column:
        return F.array_repeat(value.cast("bigint"), missing)

    return rows.withColumns(
        {
            "attention_mask": F.concat(
                F.array_repeat(F.lit(1).cast("bigint"), used), fill(F.lit(0))
            ),
            "input_ids": F.concat("input_ids", fill(F.col("_pad"))),
            "labels": F.concat("labels", fill(F.lit(IGNORED_LABEL))),
        }
    ).drop("_pad", "_length")


def batch_plan(
    rows: DataFrame,
    key: str = "content_hash",
    epochs: int = 2,
    num_workers: int = 2,
    batch_size: int = 4,
    seed: int = 42,
    bucket_digits: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds (epoch, shard, batch, pos): a full shuffle per epoch, dealt out to the workers.

    The order of an epoch is that of ``md5(key:seed + epoch)``; it differs between epochs and is
    the same on every run. Positions come in two phases instead of one global sort: rows are
    numbered inside buckets, the leading digits of the digest, and shifted by the number of rows
    in the buckets before. Digests are uniform, so no bucket is hot whatever the data. How many digits
    is chosen from the number of rows, counted here unless ``bucket_digits`` is given; the order does
    not depend on it. With ``partitions`` the rows are shuffled once into that many ranges of
    (epoch, bucket), which is also what numbering needs; a shard is a contiguous range of
    positions, so a task holds few shards and a shard gets few files. Shard sizes differ by at
    most one. The last batch of a shard may be short.
    """
    if bucket_digits is None:
        bucket_digits = bucket_digits_for(rows.select(key).count())
    digest = F.md5(F.concat(F.col(key), F.lit(":"), (F.col("epoch") + seed).cast("string")))
    ordered = (
        rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.substring("_digest", 1, bucket_digits))
    )
    counts = ordered.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = bucket_offsets(counts, bucket_digits)
    few = epochs * 16**bucket_digits <= BROADCAST_OFFSETS
    if few:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("epoch", "_bucket").orderBy("_digest", key)
    if partitions and few:
        ordered = ordered.repartitionByRange(partitions, "epoch", "_bucket")
    elif partitions:
        # The numbering and the join with the offsets both need the rows as this leaves them.
        ordered = ordered.repartition(partitions, "epoch", "_bucket")
    placed = (
        ordered.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, ["epoch", "_bucket"])
        .withColumn("_index", F.col("_offset") + F.col("_rank"))
        .withColumn("shard", F.expr(f"(_index * {num_workers}) div _total"))
        .withColumn(
            "_place", F.expr(f"_index - (shard * _total + {num_workers - 1}) div {num_workers}")
        )
    )
    return placed.select(
        "epoch",
        "shard",
        F.expr(f"_place div {batch_size}").alias("batch"),
        (F.col("_place") % batch_size).alias("pos"),
        *rows.columns,
    )


def steps_per_shard(plan: DataFrame, batch_size: int = 4) -> DataFrame:
    return plan.groupBy("epoch", "shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.ceil(F.count(F.lit(1)) / batch_size).alias("steps"),
    )


def supervised_tokens(labels: str = "labels") -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORED_LABEL)).cast("bigint")


def supervision_audit(tokenized: DataFrame, by: tuple = ()) -> DataFrame:
    """Supervised tokens per version, batch or other group, and rows that have none."""
    counted = tokenized.select(*by, supervised_tokens().alias("_n"))
    return counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("_n").alias("supervised_tokens"),
        F.min("_n").alias("min_supervised"),
        F.max("_n").alias("max_supervised"),
        F.count_if(F.col("_n") == 0).alias("unsupervised_rows"),
    )


def is_finite(loss: Column) -> Column:
    """Neither null, infinite nor NaN; NaN sorts above infinity, so it fails the comparison."""
    return F.coalesce(F.abs(loss) < F.lit(float("inf")), F.lit(False))


def epoch_loss(steps: DataFrame, keys: tuple = ("run_id", "epoch"), rank: int = 0) -> DataFrame:
    """Mean of the finite step losses of one rank, skipped steps, and whether any step counted."""
    finite = is_finite(F.col("loss"))
    return (
        steps.where(F.col("rank") == rank)
        .groupBy(*keys)
        .agg(
            F.avg(F.when(finite, F.col("loss"))).alias("loss"),
            F.count_if(finite).alias("steps"),
            F.count_if(~finite).alias("skipped_batches"),
        )
        .withColumn("valid", F.col("steps") > 0)
    )


def checkpoint_topk(checkpoints: DataFrame, keep: int = 2) -> DataFrame:
    """The ``keep`` checkpoints of each run with the lowest loss, the earlier epoch first."""
    by_loss = Window.partitionBy("run_id").orderBy("loss", "epoch")
    scored = checkpoints.where(F.col("loss").isNotNull())
    return scored.withColumn("place", F.row_number().over(by_loss)).where(F.col("place") <= keep)


def checkpoint_select(checkpoints: DataFrame) -> DataFrame:
    """Per run the checkpoint with the lowest loss, or the latest when none has a loss."""
    scored = F.col("loss").isNotNull()
    best = F.min(F.when(scored, F.struct("loss", "epoch", "checkpoint")))
    latest = F.max(F.struct("epoch", "checkpoint"))
    chosen = checkpoints.groupBy("run_id").agg(best.alias("_best"), latest.alias("_latest"))
    return chosen.select(
        "run_id",
        F.coalesce("_best.epoch", "_latest.epoch").alias("epoch"),
        F.coalesce("_best.checkpoint", "_latest.checkpoint").alias("checkpoint"),
        F.col("_best.loss").alias("loss"),
        F.when(F.col("_best").isNotNull(), "best-by-loss").otherwise("latest").alias("selection"),
    )
