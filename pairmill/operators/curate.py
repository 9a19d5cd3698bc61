"""Filtering, exact deduplication and the disjoint holdout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.functions.text import content_hash, nonblank
from pairmill.operators.selection import smallest


def drop_blank(pairs: DataFrame) -> DataFrame:
    """Rows whose instruction and response both have something left after stripping."""
    return pairs.where(nonblank(F.col("instruction")) & nonblank(F.col("response")))


def with_content_hash(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("content_hash", content_hash(F.col("instruction"), F.col("response")))


def exact_dedup(
    rows: DataFrame,
    key: str = "content_hash",
    tie_break: list[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key, and optionally how many there were.

    The survivor is the least row by ``tie_break``, then by all other columns, so a recomputed
    task picks the same one. The minimum is combined before the shuffle: a key with very many
    copies leaves each map task as a single row.
    """
    first = list(tie_break or [])
    order = first + [c for c in rows.columns if c not in (key, *first)]
    least = F.min(F.struct(*order)).alias("_row")
    count = [F.count(F.lit(1)).alias(copies)] if copies else []
    kept = rows.groupBy(key).agg(least, *count)
    columns = [F.col(key) if c == key else F.col(f"_row.{c}") for c in rows.columns]
    return kept.select(*columns, *([copies] if copies else []))


def keyed_pairs(raw: DataFrame) -> DataFrame:
    """(content_hash, instruction, response), all null where a pair is blank."""
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in ("instruction", "response")])
    usable = nonblank(F.col("instruction")) & nonblank(F.col("response"))
    pairs = texts.withColumn("_usable", usable)
    return pairs.select(
        F.when(F.col("_usable"), content_hash(F.col("instruction"), F.col("response"))).alias(
            "content_hash"
        ),
        F.when(F.col("_usable"), F.col("instruction")).alias("instruction"),
        F.when(F.col("_usable"), F.col("response")).alias("response"),
    )


def collapse_pairs(raw: DataFrame) -> DataFrame:
    """Deduplicated pairs plus one row with a null key that counts the blank ones.

    ``copies`` then adds up to the number of raw rows, so the manifest needs no second pass over
    the raw data.
    """
    return exact_dedup(keyed_pairs(raw), copies="copies")


def holdout_size(total: int, eval_rows: int = 32, max_fraction: float = 0.25) -> int:
    """At most ``eval_rows``, at most the given share of the data, but at least one row."""
    return min(eval_rows, max(1, int(total * max_fraction)))


def holdout_keys(
    deduped: DataFrame, eval_rows: int = 32, max_fraction: float = 0.25, total: int | None = None
) -> DataFrame:
    """The ``holdout_size`` smallest content hashes.

    Without ``total`` the size stays an expression and nothing runs here: the smallest
    ``eval_rows`` hashes are numbered in one task, so it has to be a small number. With ``total``
    any number is cut out by counting.
    """
    hashes = deduped.select("content_hash")
    if total is None:
        share = F.floor(F.count(F.lit(1)) * F.lit(float(max_fraction)))
        size = hashes.agg(F.least(F.lit(eval_rows), F.greatest(F.lit(1), share)))
        # Numbers the eval_rows smallest hashes only.
        rank = F.row_number().over(Window.orderBy("content_hash"))
        return (
            hashes.orderBy("content_hash").limit(eval_rows)
            .withColumn("_rank", rank)
            .where(F.col("_rank") <= size.scalar())
            .select("content_hash")
        )
    return smallest(hashes, "content_hash", holdout_size(total, eval_rows, max_fraction))


def split_holdout(
    deduped: DataFrame, eval_rows: int = 32, max_fraction: float = 0.25, total: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, eval): disjoint and together all of ``deduped``.

    Hashes are unique after deduplication and the holdout is the smallest of them, so membership
    is a comparison with the largest held-out hash. That is one string for any holdout size:
    nothing is joined or broadcast, and over a written table the comparison reaches the scan.
    """
    keys = holdout_keys(deduped, eval_rows, max_fraction, total)
    cutoff = keys.agg(F.max("content_hash"))
    train = deduped.where(F.col("content_hash") > cutoff.scalar())
    held_out = deduped.where(F.col("content_hash") <= cutoff.scalar())
    return train, held_out


def split_invariants(deduped: DataFrame, train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Rows of each side, rows on both, and rows on neither, as one row of counts."""
    sides = (
        deduped.select("content_hash", F.lit(1).alias("whole"), F.lit(0).alias("train"),
                       F.lit(0).alias("eval"))
        .unionByName(train.select("content_hash", F.lit(0).alias("whole"), F.lit(1).alias("train"),
                                  F.lit(0).alias("eval")))
        .unionByName(held_out.select("content_hash", F.lit(0).alias("whole"),
                                     F.lit(0).alias("train"), F.lit(1).alias("eval")))
    )
    per_hash = sides.groupBy("content_hash").agg(
        F.sum("whole").alias("whole"), F.sum("train").alias("train"), F.sum("eval").alias("eval")
    )
    return per_hash.agg(
        F.sum("whole").alias("deduped_rows"),
        F.sum("train").alias("train_rows"),
        F.sum("eval").alias("eval_rows"),
        F.count_if((F.col("train") > 0) & (F.col("eval") > 0)).alias("in_both"),
        F.count_if(F.col("train") + F.col("eval") != F.col("whole")).alias("not_covered"),
    )
