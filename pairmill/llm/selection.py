"""Dropping rows by a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.session import scratch_path

# A list of up to so many ids is broadcast; a longer one is joined by a shuffle.
BROADCAST_IDS = 1_000_000


def without(rows: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows whose id is not in the list. Rows without an id stay."""
    path = scratch_path(rows.sparkSession, "dropped")
    ids.where(F.col(id_column).isNotNull()).distinct().write.parquet(path)
    dropped = rows.sparkSession.read.schema(ids.schema).parquet(path)
    if dropped.count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, id_column, "left_anti")
