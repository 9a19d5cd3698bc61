import hashlib
import random

import pytest
from rows import collected, table
from pyspark.sql import functions as F

from pairmill.operators import curate
from pairmill.operators.selection import smallest
from pairmill.sources import raw


@pytest.mark.parametrize(
    "total,size",
    [(1, 1), (2, 1), (4, 1), (8, 2), (100, 25), (127, 31), (128, 32), (1000, 32)],
)
def test_holdout_sizes(spark, total, size):
    assert curate.holdout_size(total) == size
    rows = spark.range(total).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))
    want = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(total))[:size]
    assert [r[0] for r in curate.holdout_keys(rows).orderBy("content_hash").collect()] == want
    train, held_out = curate.split_holdout(rows)
    assert held_out.count() == size and train.count() == total - size
    train, held_out = curate.split_holdout(rows, total=total)
    assert [r[0] for r in held_out.orderBy("content_hash").collect()] == want


def test_demo_pairs_give_the_known_counts(spark):
    demo = raw.demo_pairs(spark)
    assert demo.count() == 128
    deduped = curate.exact_dedup(curate.with_content_hash(demo), copies="copies")
    assert {r["copies"] for r in deduped.collect()} == {16}
    assert {r["repeat"] for r in deduped.collect()} == {0}
    train, held_out = curate.split_holdout(deduped)
    assert (train.count(), held_out.count()) == (6, 2)


def test_dedup_keeps_the_least_row_and_tells_texts_with_nul_apart_only_by_hash(spark):
    rows = table(
        spark,
        [("a\0b", "c", 2), ("a", "b\0c", 1), ("a", "b", 3), ("a", "b", 0), ("a ", "b", 9)],
        "instruction string, response string, n int",
    )
    kept = curate.exact_dedup(curate.with_content_hash(rows), tie_break=["n"])
    assert collected(kept.select("n")) == [(0,), (1,), (9,)]


def test_collapse_counts_blank_rows_under_a_null_key(spark):
    rows = table(
        spark,
        [("a", "b"), ("a", "b"), (None, "b"), ("a", " "), ("", ""), (" a", "b")],
        "instruction string, response string",
    )
    got = curate.collapse_pairs(rows)
    assert got.where("content_hash is null").first()["copies"] == 3
    assert collected(got.where("content_hash is not null").select("instruction", "copies")) == [
        (" a", 1), ("a", 2),
    ]


@pytest.mark.parametrize("n", [1, 7, 40, 250, 999, 1000, 5000])
def test_smallest_by_counting_equals_sorting(spark, n):
    digests = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(1000))
    rows = table(spark, [(d,) for d in digests], "key string")
    got = smallest(rows, "key", n, in_one_task=5)
    assert [r[0] for r in got.orderBy("key").collect()] == digests[:n]


def test_invariants_notice_a_row_on_both_sides(spark):
    rows = spark.range(20).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))
    train, held_out = curate.split_holdout(rows)
    assert tuple(curate.split_invariants(rows, train, held_out).first()) == (20, 15, 5, 0, 0)
    broken = curate.split_invariants(rows, train.unionByName(held_out.limit(1)), held_out).first()
    assert (broken["in_both"], broken["not_covered"]) == (1, 1)


TURNS = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    pairs, ordered = [], sorted(rows, key=lambda r: (r[0], r[1]))
    for one, two in zip(ordered, ordered[1:]):
        if one[0] == two[0] and (one[2], two[2]) == ("user", "assistant"):
            pairs.append((one[0], one[1], one[3], two[3]))
    return sorted(pairs)


def test_pairs_follow_the_next_turn_across_gaps_and_chunks(spark):
    draw = random.Random(5)
    rows = [(0, 0, "user", "q"), (0, 2, "assistant", "a"), (1, 0, "assistant", "x"), (1, 9, "user", "y")]
    for conv in range(2, 12):
        turn = 0
        # One conversation holds most rows; steps cross chunks of both sizes.
        for i in range(3000 if conv == 2 else 30):
            rows.append((conv, turn, draw.choice(["user", "assistant", "system"]), f"{conv}:{i}"))
            turn += draw.choice([1, 1, 2, 63, 64, 65, raw.CHUNK_TURNS * 40, raw.SPAN_TURNS])
    draw.shuffle(rows)
    pairs = raw.pairs_from_conversations(table(spark, rows, TURNS))
    got = pairs.select("conv_id", "turn", "instruction", "response")
    assert collected(got) == by_hand(rows)


def test_pairs_read_and_shuffle_the_turns_once(spark, folder):
    table(spark, [(0, 0, "user", "q")], TURNS).write.parquet(folder)
    pairs = raw.pairs_from_conversations(spark.read.parquet(folder))
    pairs.collect()
    text = pairs._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
