"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.session import scratch_path


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its smallest node.

    Alternates two contractions until nothing changes: every node links its larger neighbours to
    the smallest one it knows, then its smaller ones. The number of rounds grows with the
    logarithm of the graph, no node's neighbours are ever collected, and each round is written to
    the shared folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "components")
    kind = edges.schema["a"].dataType.simpleString()

    def written(rows: DataFrame, step: str) -> DataFrame:
        rows.write.parquet(f"{root}/{step}")
        return spark.read.schema(f"a {kind}, b {kind}").parquet(f"{root}/{step}")

    def ordered(rows: DataFrame) -> DataFrame:
        pairs = rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return pairs.where("a > b").distinct()

    def smallest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("a").agg(F.min("b").alias("m"))

    current = written(ordered(edges), "0")
    before, step = None, 0
    while True:
        step += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The smallest of a node and its neighbours; larger neighbours go to it.
        least = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = ordered(large)
        # The same for smaller neighbours and the node itself.
        least = smallest(large)
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        current = written(ordered(small), str(step))
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
