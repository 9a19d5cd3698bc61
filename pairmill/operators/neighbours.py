"""The row before each row of a long sequence, without one task per sequence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_previous(
    rows: DataFrame, key: str, order: list[str], levels: list[Column], carried: Column,
    backwards: bool = False, wanted: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Adds ``previous``, the ``carried`` value of the row before in the order of the key's rows.

    ``levels`` number ever larger chunks of the order, so that a hot key spreads over tasks. The
    rows are shuffled once, by key and smallest chunk. Only the first and last row of each chunk
    go on to the next level, and of those again only the first and last; the last level is the
    key itself. ``wanted`` filters a level's rows as soon as their previous row is known.
    ``backwards`` looks at the row behind instead.
    """
    direction = [F.col(c).desc() if backwards else F.col(c).asc() for c in order]
    current = rows.withColumn("_carried", carried)
    found = []
    for depth in range(len(levels) + 1):
        part = [key]
        if depth < len(levels):
            # Made where it is needed, so that all branches share the first shuffle.
            current = current.withColumn(f"_level{depth}", levels[depth])
            part.append(f"_level{depth}")
        inside = Window.partitionBy(*part).orderBy(*direction)
        placed = (
            current.withColumn("previous", F.lag("_carried").over(inside))
            .withColumn("_first", F.row_number().over(inside) == 1)
            .withColumn("_last", F.lead(F.lit(False), 1, True).over(inside))
        )
        # A row that was resolved below only serves as a neighbour here.
        open_rows = F.lit(True) if depth == 0 else F.col("_open")
        top = depth == len(levels)
        settled = placed.where(open_rows if top else open_rows & ~F.col("_first"))
        found.append(wanted(settled).select(*rows.columns, "previous"))
        current = placed.where(F.col("_first") | F.col("_last")).withColumn(
            "_open", open_rows & F.col("_first")
        ).drop("previous", "_first", "_last")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
