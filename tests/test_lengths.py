import random

from pyspark.sql import functions as F
from rows import collected, table

from pairmill.operators import lengths


def exact(values, percent):
    ordered = sorted(values)
    return ordered[(len(ordered) * percent + 99) // 100 - 1]


def test_buckets_hold_their_lengths_within_one_part_in_64(spark):
    values = [*range(3000), *[2**k + d for k in range(12, 40) for d in (-1, 0, 1)]]
    rows = table(spark, [(v,) for v in values], "v bigint")
    for value, longest in rows.select("v", lengths.bucket(F.col("v"))).collect():
        assert value <= longest <= value + value / 64
        assert value > 127 or longest == value
    ordered = [r[0] for r in rows.orderBy("v").select(lengths.bucket(F.col("v"))).collect()]
    assert ordered == sorted(ordered)
    odd = table(spark, [(None,), (-4,)], "v bigint").select(lengths.bucket(F.col("v")))
    assert [r[0] for r in odd.collect()] == [None, None]


def test_quantiles_of_merged_sketches_are_those_of_the_whole(spark):
    rng = random.Random(3)
    rows = [(g, int(rng.lognormvariate(5, 2))) for g in ("a", "b") for _ in range(700)]
    rows += [("c", 0), ("c", None), ("d", None)]
    frame = table(spark, rows, "g string, tokens int")
    parts = [lengths.length_sketch(frame.where(F.col("tokens") % 3 == k), ("g",)) for k in range(3)]
    whole = lengths.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), ("g",))
    assert collected(whole) == collected(lengths.length_sketch(frame, ("g",)))
    percents = (1, 50, 90, 99, 100)
    found = {(r[0], r[1]): r[2] for r in lengths.sketch_quantiles(whole, ("g",), percents).collect()}
    for g in "abc":
        values = [n for name, n in rows if name == g and n is not None]
        for p in percents:
            true = exact(values, p)
            assert true <= found[g, p] <= true * (1 + 1 / 64)
    assert not any(g == "d" for g, _ in found)


def test_capacity_falls_with_the_quantile(spark):
    budgets = table(spark, [("s", 10_000.0)], "source string, token_budget double")
    tokens = table(spark, [("s", n) for n in range(1, 101)], "source string, tokens int")
    got = lengths.capacity_at_quantiles(budgets, tokens, ("source",))
    assert collected(got.select("percent", "length", "sequences")) == [
        (50, 50, 200), (90, 90, 111), (99, 99, 101)]


def test_a_sketch_is_combined_before_its_one_shuffle(spark):
    tokens = table(spark, [], "source string, tokens int")
    plan = lengths.length_sketch(tokens, ("source",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
