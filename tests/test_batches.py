import hashlib

import pytest
from pyspark.sql import functions as F
from rows import collected, table

from pairmill.config import PrepConfig, TrainConfig
from pairmill.operators import training
from pairmill.plans.handoff import write_batches
from pairmill.plans.prepare import prepare
from pairmill.sources import batches


def keyed(spark, n):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    return table(spark, [(k,) for k in keys], "content_hash string")


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_digits_grow_with_the_rows():
    assert [training.bucket_digits_for(n, 100) for n in (0, 1600, 1601, 25_600, 25_601)] == [1, 1, 2, 2, 3]
    assert training.bucket_digits_for(10**30) == training.MOST_DIGITS


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_two_levels_give_the_offsets_of_one(spark, digits):
    rows = keyed(spark, 500).select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("epoch"),
        F.substring(F.md5(F.col("content_hash")), 1, digits).alias("_bucket"),
    )
    counts = rows.groupBy("epoch", "_bucket").agg(F.count("*").alias("_n"))
    found = training.bucket_offsets(counts, digits).collect()
    sizes = {(r[0], r[1]): r[2] for r in counts.collect()}
    assert len(found) == len(sizes)
    for epoch, bucket, offset, total in found:
        assert offset == sum(n for (e, b), n in sizes.items() if e == epoch and b < bucket)
        assert total == 500
    text = plan_text(training.bucket_offsets(counts, digits))
    assert "SinglePartition" not in text


def test_the_order_depends_on_neither_digits_nor_the_way_of_joining(spark, monkeypatch):
    rows = keyed(spark, 300)
    want = collected(training.batch_plan(rows, num_workers=3))
    for digits in (1, 2, 4):
        assert collected(training.batch_plan(rows, num_workers=3, bucket_digits=digits)) == want
    monkeypatch.setattr(training, "BROADCAST_OFFSETS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = training.batch_plan(rows, num_workers=3, partitions=5, bucket_digits=2)
        assert collected(plan) == want
        # Rows are shuffled once; the numbering and the join with the offsets share that.
        text = plan_text(plan)
        assert text.count("REPARTITION_BY_NUM") == 1 and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def laid_out(spark, folder, n=60, batch_size=4):
    pairs = table(
        spark, [(f"question {i}", f"answer {i} in some words") for i in range(n)],
        "instruction string, response string",
    )
    config = PrepConfig(f"{folder}/raw", f"{folder}/data", "one", "base", max_len=200)
    prepare(spark, config, pairs)
    train = TrainConfig(f"{folder}/data", run_id="one", batch_size=batch_size)
    write_batches(spark, train, f"{folder}/batches")
    return f"{folder}/batches"


def test_resuming_anywhere_gives_the_same_rest(spark, folder):
    output = laid_out(spark, folder)
    rows = spark.read.parquet(output)
    assert rows.count() == 2 * rows.select("content_hash").distinct().count()
    for epoch, shard in ((0, 0), (0, 1), (1, 1)):
        own = [
            tuple(r) for r in rows.where((F.col("epoch") == epoch) & (F.col("shard") == shard))
            .orderBy("batch", "pos").select("batch", "pos", "content_hash", "labels").collect()
        ]
        steps = own[-1][0] + 1
        for batch in (0, 1, steps // 2, steps - 1, steps, steps + 5):
            got = batches.resume(spark, output, epoch, shard, batch)
            rest = [tuple(r) for r in got.select("batch", "pos", "content_hash", "labels").collect()]
            assert rest == [r for r in own if r[0] >= batch]
            told = batches.remaining(spark, output, epoch, shard, batch)
            assert (told.agg(F.sum("rows")).first()[0] or 0) == len(rest)


def test_the_index_says_where_a_batch_lies(spark, folder):
    output = laid_out(spark, folder, batch_size=5)
    placed = spark.read.parquet(output).select(
        "epoch", "shard", "batch", "pos", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    index = {}
    for e in batches.read_index(spark, output).collect():
        index[e["epoch"], e["shard"], e["batch"], e["file"]] = e
    for r in placed.collect():
        entry = index[r["epoch"], r["shard"], r["batch"], r["file"]]
        assert r["row"] == entry["first_row"] + r["pos"] - entry["first_pos"]
    assert sum(e["rows"] for e in index.values()) == placed.count()


def test_only_later_row_groups_are_read(spark, folder):
    """A file of many row groups: the scan gives out no row of those before the batch."""
    rows = spark.range(0, 4000, numPartitions=1).select(
        (F.col("id") / 4).cast("bigint").alias("batch"), (F.col("id") % 4).alias("pos"),
        F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), F.lit(0).alias("epoch"),
        F.lit(0).alias("shard"),
    )
    rows.write.option("parquet.block.size", 4096).option(
        "parquet.block.size.row.check.min", 10
    ).option("parquet.page.size.row.check.min", 10).option(
        "parquet.block.size.row.check.max", 100).partitionBy("epoch", "shard").parquet(folder)
    batches.index_batches(spark, folder)

    text = plan_text(batches.resume(spark, folder, 0, 0, 900))
    assert "GreaterThanOrEqual(batch,900)" in text
    # The comparison as resume() makes it, run below its sort.
    scan = spark.read.parquet(f"{folder}/epoch=0/shard=0").where(F.col("batch") >= 900)
    execution = scan._jdf.queryExecution()
    assert execution.toRdd().count() == 400
    metrics = execution.executedPlan().collectLeaves().apply(0).metrics()
    # Rows that the scan gave out before the filter looked at them.
    assert 400 <= metrics.apply("numOutputRows").value() < 1000
