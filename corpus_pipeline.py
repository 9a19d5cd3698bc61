"""The corpus pipeline: quality, toxicity, near duplicates, benchmark leaks, packing.

Every stage takes all that the one before kept, is written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm.jaccard import jaccard_components
from pairmill.llm.packing import best_fit_packing
from pairmill.llm.quality import fit_quality, with_score
from pairmill.llm.queries import table, vocabulary_path
from pairmill.llm.selection import without
from pairmill.llm.templates import contaminated
from pairmill.llm.toxicity import fit_toxicity
from pairmill.session import scratch_path

LEAST_QUALITY = 0.5
MOST_TOXICITY = 0.3
SHINGLE_WORDS, SIMILARITY = 5, 80


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not use."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    score = _free(docs, "quality")
    return with_score(docs, model, score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity classifier marks."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    score = _free(docs, "toxicity")
    return with_score(docs, model, score).where(F.col(score) < MOST_TOXICITY).drop(score)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates keeps the document with the smallest id.

    Rows of one id stay or go together; rows without an id stay.
    """
    groups = jaccard_components(docs, SHINGLE_WORDS, SIMILARITY, count_links=False)
    return without(docs, groups.where("doc_id <> component_id").select("doc_id"), "doc_id")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark, also with other parameters."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.select("doc_id"), "doc_id")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places what is left into sequences."""
    return best_fit_packing(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", no_benchmark),
    ("best_fit_packing", packed),
]

# Trained models, components of a similarity join and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
