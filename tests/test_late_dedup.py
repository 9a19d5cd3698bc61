import re

from pyspark.sql import functions as F
from rows import collected, table

from pairmill.operators import curate
from pairmill.operators.late_dedup import fetch, first_places, late_dedup, place_rows

SCHEMA = "id bigint, instruction string, response string"


def some_rows(spark, n=1000):
    # A third of all rows are copies of one pair.
    rows = [(i, "hot" if i % 3 == 0 else f"q{i % 211}", "same") for i in range(n)]
    return curate.with_content_hash(table(spark, rows, SCHEMA).repartition(7, "id"))


def test_same_survivors_as_by_whole_rows(spark):
    rows = some_rows(spark)
    late = late_dedup(rows, tie_break=["id"], copies="copies")
    whole = curate.exact_dedup(rows, tie_break=["id"], copies="copies")
    assert collected(late) == collected(whole.select(late.columns))


def test_without_tie_break_the_first_in_reading_order_stays(spark):
    rows = some_rows(spark).coalesce(1).sortWithinPartitions(F.desc("id"))
    got = late_dedup(rows).select("id", "content_hash")
    want = rows.groupBy("content_hash").agg(F.max("id").alias("id")).select("id", "content_hash")
    assert collected(got) == collected(want)


def test_null_keys_and_empty_tables(spark):
    schema = "content_hash string, text string"
    rows = table(spark, [(None, "a"), ("k", "b"), ("k", "c"), (None, None)], schema).coalesce(1)
    assert collected(late_dedup(rows, copies="n")) == [("k", "b", 2)]
    assert collected(late_dedup(rows.where("content_hash is null"))) == []
    assert collected(late_dedup(rows.where("text = 'none'"), copies="n")) == []


def test_rows_are_fetched_by_place(spark):
    placed = place_rows(spark.range(0, 500, numPartitions=3).withColumnRenamed("id", "n"))
    places = placed.rows.where("n % 5 = 0").select("_part", "_row", F.lit(1).cast("bigint").alias("copies"))
    assert [r[0] for r in collected(fetch(placed, places))] == list(range(0, 500, 5))


def test_no_text_is_shuffled(spark):
    placed = place_rows(some_rows(spark))
    found = fetch(placed, first_places(placed, "content_hash", ["id"]), "copies")
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange .*", plan)
    assert exchanges and not any("response" in e or "instruction" in e for e in exchanges)
    # The table is read as it lies: what streams through the join is neither sorted nor shuffled.
    join = plan.split("ShuffledHashJoin")[1]
    streamed = join[: join.index("FileScan")]
    assert "Exchange" not in streamed and "Sort" not in streamed
    below = join[join.index("FileScan") :].split("FileScan")[2:]
    assert below and all("response" not in scan.split("ReadSchema")[1] for scan in below)
