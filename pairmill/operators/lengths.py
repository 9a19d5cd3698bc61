"""Sketches of sequence lengths per group: small, mergeable, and exact about how wrong they are.

A length falls into a bucket named by the largest length in it. Up to 127 every length has its own; above,
every doubling has 64 buckets. A quantile read off a sketch is the bucket of the exact quantile, so it is never
too small, and too large by at most one part in 64. A group has at most a few thousand rows whatever
it holds, and sketches of parts are added by summing rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Leading bits that tell buckets apart; the relative error is below 2 to the power of 1 minus this.
BITS = 7
PERCENTS = (50, 90, 99)


def bucket(length: Column) -> Column:
    """The largest length of the bucket, in whole numbers throughout; null for null or negatives."""
    value = length.cast("bigint")
    shift = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    leading = F.call_function("shiftright", value, shift)
    return F.when(value >= 0, F.call_function("shiftleft", leading + 1, shift) - 1)


def length_sketch(tokens: DataFrame, by: tuple = (), length: str = "tokens") -> DataFrame:
    """(by, longest, rows): rows per bucket; lengths that are null or negative are left out."""
    named = tokens.select(*by, bucket(F.col(length)).alias("longest"))
    return named.where(F.col("longest").isNotNull()).groupBy(*by, "longest").agg(
        F.count(F.lit(1)).alias("rows")
    )


def merged_sketches(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """The sketch of several parts together."""
    return sketches.groupBy(*by, "longest").agg(F.sum("rows").alias("rows"))


def sketch_quantiles(
    sketch: DataFrame, by: tuple = (), percents: tuple = PERCENTS
) -> DataFrame:
    """(by, percent, length): the least bucket with at least that percentage of the rows up to it."""
    group = Window.partitionBy(*by)
    upto = group.orderBy("longest").rowsBetween(Window.unboundedPreceding, 0)
    placed = sketch.select(
        *by, "longest", F.sum("rows").over(upto).alias("_upto"), F.sum("rows").over(group).alias("_all")
    )
    asked = placed.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents])))
    reached = F.col("_upto") * 100 >= F.col("_all") * F.col("percent")
    return asked.where(reached).groupBy(*by, "percent").agg(F.min("longest").alias("length"))


def capacity_at_quantiles(
    accounted: DataFrame, tokens: DataFrame, by: tuple, percents: tuple = PERCENTS,
    length: str = "tokens",
) -> DataFrame:
    """Sequences that fit where all are as long as a quantile of what was observed.

    ``accounted`` has the token budget of each configuration and the columns ``by``.
    """
    quantiles = sketch_quantiles(length_sketch(tokens, by, length), by, percents)
    fit = F.floor(F.col("token_budget") / F.greatest(F.col("length"), F.lit(1)))
    return accounted.join(quantiles, list(by)).withColumn("sequences", fit)
