"""The n smallest rows by a hash key, whatever n is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of the group the cut falls into that one task may sort.
IN_ONE_TASK = 100_000
# Hex digits per counting round: at most 65,536 counts reach the driver.
DIGITS = 4


def smallest(rows: DataFrame, key: str, n: int, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """The ``n`` rows smallest by ``key``, a column of unique lower-case hex digests.

    Nothing large is sorted in one task. Rows are counted by the leading digits of the key until
    the cut falls into a group small enough to sort; every row below that group is kept by a
    plain comparison.
    """
    prefix, left, size = "", n, None
    while size is None or size > in_one_task:
        groups = (
            rows.where(F.col(key).startswith(prefix))
            .groupBy(F.substring(key, 1, len(prefix) + DIGITS).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("size"))
            .orderBy("prefix")
            .collect()
        )
        for group in groups:
            if left <= group["size"]:
                prefix, size = group["prefix"], group["size"]
                break
            left -= group["size"]
        else:
            return rows
    inside = rows.where(F.col(key).startswith(prefix)).orderBy(key).limit(left)
    return rows.where(F.col(key) < prefix).unionByName(inside)
