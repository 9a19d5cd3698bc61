import hashlib

import pytest
from rows import collected, table

from pairmill.operators import training


def brute_plan(keys, epochs, workers, size, seed=42):
    rows = []
    for epoch in range(epochs):
        order = sorted(keys, key=lambda k: hashlib.md5(f"{k}:{seed + epoch}".encode()).hexdigest())
        place = {}
        for index, key in enumerate(order):
            shard = index * workers // len(keys)
            at = place[shard] = place.get(shard, -1) + 1
            rows.append((epoch, shard, at // size, at % size, key))
    return sorted(rows)


@pytest.mark.parametrize("n,workers,size,digits", [(1, 2, 4, 3), (10, 3, 4, 1), (97, 4, 5, 2)])
def test_batch_plan(spark, n, workers, size, digits):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    plan = training.batch_plan(
        table(spark, [(k,) for k in keys], "content_hash string"),
        num_workers=workers, batch_size=size, bucket_digits=digits,
    )
    assert collected(plan) == brute_plan(keys, 2, workers, size)
    sizes = [r["rows"] for r in training.steps_per_shard(plan, size).where("epoch = 0").collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_ranges_give_the_same_plan_in_one_shuffle(spark):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(97)]
    rows = table(spark, [(k,) for k in keys], "content_hash string")
    plan = training.batch_plan(rows, num_workers=3, partitions=5)
    assert collected(plan) == brute_plan(keys, 2, 3, 4)
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Of the rows; the other shuffles are those of the bucket counts.
    assert text.count("Exchange rangepartitioning") == 1 and "SinglePartition" not in text


def test_padding_is_cut_and_restored(spark):
    rows = [
        ("a", [5, 6, 9, 0, 0], [1, 1, 1, 0, 0], [-100, 6, 9, -100, -100]),
        ("b", [5, 6, 7, 8, 9], [1, 1, 1, 1, 1], [-100, -100, -100, 8, 9]),
        ("c", [9, 9, 9, 9, 9], [1, 0, 0, 0, 0], [9, -100, -100, -100, -100]),
    ]
    kinds = "key string, input_ids array<bigint>, attention_mask array<bigint>, labels array<bigint>"
    frame = table(spark, rows, kinds)
    cut = training.cut_padding(frame)
    assert sorted(len(r["labels"]) for r in cut.collect()) == [1, 3, 5]
    back = training.restore_padding(cut).select(*frame.columns)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_supervision(spark):
    rows = [([-100, 1, 2],), ([-100, -100, 3],), ([-100] * 3,)]
    got = training.supervision_audit(table(spark, rows, "labels array<bigint>")).first()
    assert tuple(got) == (3, 3, 0, 2, 1)


SCHEMA = "run_id string, epoch int, loss double, checkpoint string"


def test_checkpoints(spark):
    rows = [("a", 0, 2.0, "a0"), ("a", 1, 1.0, "a1"), ("a", 2, 1.0, "a2"), ("a", 3, None, "a3"),
            ("b", 0, None, "b0"), ("b", 1, None, "b1")]
    frame = table(spark, rows, SCHEMA)
    assert collected(training.checkpoint_topk(frame).select("checkpoint", "place")) == [
        ("a1", 1), ("a2", 2),
    ]
    assert collected(training.checkpoint_select(frame).select("run_id", "checkpoint", "selection")) == [
        ("a", "a1", "best-by-loss"), ("b", "b1", "latest"),
    ]
