"""Bounded, repeatable samples of documents to fit a classifier on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.pu import PuSettings, estimated_prior


def fold(id_column: Column, folds: int) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % folds


@dataclass
class Sample:
    """``keys``: (_id, positive) of the documents to fit on, an id at most once in each role."""

    keys: DataFrame
    prior: float
    positives: int
    unlabelled: int


def _thinned(rows: DataFrame, count: int, most: int) -> DataFrame:
    """About ``most`` of ``count`` rows, by a hash of the id."""
    if count <= most:
        return rows
    spread = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 40))
    return rows.where(spread < int((1 << 40) * most / count))


def pu_sample(
    documents: DataFrame, labels: DataFrame, label_column: str, folds: int, held_out: int,
    settings: PuSettings, id_column: str = "doc_id",
) -> Sample:
    """Draws positives and unlabelled documents outside the held-out fold.

    A document is positive if any of its label rows is 1. Rows without an id are not drawn.
    """
    ids = documents.select(F.col(id_column).alias("_id")).where(F.col("_id").isNotNull())
    ids = ids.where(fold(F.col("_id"), folds) != held_out).distinct()
    marks = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    known = ids.join(marks, "_id", "left")
    counted = known.agg(
        F.count("*").alias("all"), F.count("_label").alias("labelled"),
        F.count_if(F.col("_label") == 1).alias("positive"),
    ).first()
    positives = _thinned(
        known.where(F.col("_label") == 1), counted["positive"], settings.max_positive
    )
    unlabelled = _thinned(known, counted["all"], settings.max_unlabelled)
    keys = positives.select("_id", F.lit(True).alias("positive")).unionByName(
        unlabelled.select("_id", F.lit(False).alias("positive"))
    )
    return Sample(
        keys, estimated_prior(counted["positive"], counted["labelled"]),
        min(counted["positive"], settings.max_positive),
        min(counted["all"], settings.max_unlabelled),
    )


def sampled_documents(
    documents: DataFrame, sample: Sample, id_column: str, text_column: str
) -> DataFrame:
    """(_id, positive, _text) of the sample. Its size is bounded, so its keys may be broadcast."""
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    return source.join(F.broadcast(sample.keys), "_id")
