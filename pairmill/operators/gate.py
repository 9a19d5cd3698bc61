"""Acceptance of generated rows by the share of unusable ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.functions.text import nonblank


def is_usable(value: Column) -> Column:
    """A text with something left after stripping; null is unusable, the text "None" is not."""
    return nonblank(value)


def accept_sample(generated: DataFrame, sample: int = 0, by: tuple = ()) -> DataFrame:
    """(by, usable, copies) of all rows, or of the ``sample`` first ones in the order of a digest.

    A top-n over narrow rows: equal rows are neighbours in the order, so the sample is the same on
    every run and needs no shuffle of all keys. With ``by`` it is a sample of each group: the
    smallest digests of a part of the rows are among those of the part's tasks, so every task keeps
    ``sample`` rows of a group before anything is shuffled, and a hot group costs no more than others.
    """
    usable = is_usable(F.col("generated")).alias("usable")
    one = F.lit(1).alias("copies")
    if sample == 0:
        return generated.select(*by, usable, one)
    # A present value is marked, so that null and empty differ.
    parts = [
        F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
        for c in ("instruction", "reference", "generated")
    ]
    keyed = generated.select(*by, F.sha2(F.concat_ws("\0", *parts), 256).alias("_key"), usable)
    if not by:
        return keyed.orderBy("_key").limit(sample).select("usable", one)
    smallest = Window.partitionBy(*by).orderBy("_key")
    ranked = keyed.withColumn("_rank", F.row_number().over(smallest))
    return ranked.where(F.col("_rank") <= sample).select(*by, "usable", one)


def acceptance_report(
    generated: DataFrame, sample: int = 0, max_empty_fraction: float = 0.0, by: tuple = ()
) -> DataFrame:
    """Rows checked and unusable, their share, and whether it is within the limit.

    One combined aggregate over all rows or a sample; with ``by`` one report per group, over all
    rows or a sample of each group.
    """
    rows = accept_sample(generated, sample, by)
    counts = rows.groupBy(*by).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(~F.col("usable"), F.col("copies"))), F.lit(0)).alias(
            "rows_unusable"
        ),
    )
    fraction = F.col("rows_unusable") / F.when(F.col("rows_checked") > 0, F.col("rows_checked"))
    return counts.select(
        *by,
        "rows_checked",
        "rows_unusable",
        fraction.alias("empty_fraction"),
        F.lit(float(max_empty_fraction)).alias("max_empty_fraction"),
        (fraction <= max_empty_fraction).alias("passed"),
    )


def preview(generated: DataFrame, rows: int = 2) -> DataFrame:
    """The first rows with their answers cut to 200 characters."""
    return generated.limit(rows).select(
        F.col("instruction").alias("q"), F.substring("generated", 1, 200).alias("a")
    )
