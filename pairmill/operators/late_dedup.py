"""Exact deduplication that never shuffles a text.

Rows are written once, as they come, with a place of their own: the number of the task that wrote them and
their number in that task. Duplicates are found from key and place alone. Survivors are then fetched by
place: the written table is bucketed by task, so it is read where it lies, and what is brought to it is
one bit per row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.session import SHUFFLE_BYTES, input_bytes, scratch_path

# Rows that share one word of bits, and the bits of a row's number within its task.
WORD_ROWS = 32
MOST_BUCKETS = 20_000
ROW_BITS = 33
PART, ROW = "_part", "_row"
# The bit of a row in its word, and the word among those of its task.
BIT = f"shiftleft(1L, int({ROW} % {WORD_ROWS}))"
WORD = f"words[int({ROW} div {WORD_ROWS})]"


@dataclass(frozen=True)
class Placed:
    """A written table whose rows have a place (``_part``, ``_row``)."""

    rows: DataFrame
    columns: list[str]
    path: str


def place_columns(place: Column) -> list[Column]:
    """Task and row of a number that ``monotonically_increasing_id`` gives."""
    return [
        F.shiftright(place, ROW_BITS).cast("int").alias(PART),
        place.bitwiseAND((1 << ROW_BITS) - 1).alias(ROW),
    ]


def place_rows(rows: DataFrame, purpose: str = "placed") -> Placed:
    """Writes the rows, each task into one file, without a shuffle."""
    spark = rows.sparkSession
    size = input_bytes(rows)
    # A bucket is streamed through, so for an input of unknown size their number is not critical.
    tasks = 4 * spark.sparkContext.defaultParallelism if size is None else size // SHUFFLE_BYTES
    buckets = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = rows.withColumn("_place", F.monotonically_increasing_id()).select(
        *rows.columns, *place_columns(F.col("_place"))
    )
    path = scratch_path(spark, purpose)
    name = f"pairmill_{uuid.uuid4().hex}"
    buckets = min(buckets, MOST_BUCKETS)
    numbered.write.bucketBy(buckets, PART).option("path", path).saveAsTable(name)
    written = spark.table(name)
    # What was read keeps its buckets; only the name goes, the files stay.
    spark.sql(f"DROP TABLE {name}")
    return Placed(written, rows.columns, path)


def first_places(placed: Placed, key: str, tie_break: list[str] | None = None) -> DataFrame:
    """(_part, _row, copies) of the first row of each key, by ``tie_break``, then by place.

    Only these columns are read and shuffled, combined before that, so a hot key is one row per task.
    Rows with a null key have no first one.
    """
    # Without a tie-break the place is one number, which aggregates without sorting.
    place = F.shiftleft(F.col(PART).cast("long"), ROW_BITS) + F.col(ROW)
    least = F.min(F.struct(*tie_break, place.alias("place")))["place"] if tie_break else F.min(place)
    known = placed.rows.where(F.col(key).isNotNull())
    firsts = known.groupBy(key).agg(least.alias("place"), F.count(F.lit(1)).alias("copies"))
    return firsts.select(*place_columns(F.col("place")), "copies")


def place_bits(placed: Placed, places: DataFrame) -> DataFrame:
    """(_part, words): per task an array with one element for every 32 rows.

    An element has a bit per row that is wanted and the copies of those rows in their order.
    """
    last = placed.rows.groupBy(PART).agg(F.max(ROW).alias("last"))
    every = last.select(PART, F.expr(f"explode(sequence(0L, last div {WORD_ROWS}))").alias("word"))
    words = places.groupBy(PART, F.expr(f"{ROW} div {WORD_ROWS}").alias("word")).agg(
        F.bit_or(F.expr(BIT)).alias("bits"),
        F.array_sort(F.collect_list(F.struct(ROW, "copies")))["copies"].alias("copies"),
    )
    dense = every.join(words, [PART, "word"], "left").fillna(0, ["bits"])
    # As many elements as one task wrote rows, divided by 32.
    return dense.groupBy(PART).agg(
        F.array_sort(F.collect_list(F.struct("word", "bits", "copies"))).alias("words")
    )


def fetch(placed: Placed, places: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows at the given places; the table itself is neither sorted nor shuffled."""
    bits = place_bits(placed, places).hint("shuffle_hash")
    found = placed.rows.join(bits, PART).where(F.expr(f"({WORD}.bits & {BIT}) <> 0"))
    # How many wanted rows of the same word come before.
    before = F.expr(f"{WORD}.copies[int(bit_count({WORD}.bits & ({BIT} - 1)))]")
    return found.select(*placed.columns, *([before.alias(copies)] if copies else []))


def late_dedup(
    rows: DataFrame, key: str = "content_hash", tie_break: list[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key, the first by ``tie_break`` and then in the order of reading.

    Rows with a null key are dropped. Unlike ``exact_dedup`` the other columns are no part of the
    order, so they are never compared or sent; the survivor is still the same on every run over
    the written table.
    """
    placed = place_rows(rows)
    return fetch(placed, first_places(placed, key, tie_break), copies)
