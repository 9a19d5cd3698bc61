"""Immutable versions behind a pointer: readers follow the pointer once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairmill.errors import JobFailed
from pairmill.sources import files
from pairmill.sources.raw import RAW_SCHEMA

POINTER = "current"


def resolve(spark: SparkSession, path: str) -> str:
    """The version folder that ``path``, a root with a pointer or a version itself, stands for."""
    path = path.rstrip("/")
    if not files.exists(spark, path):
        raise JobFailed(f"{path} not found")
    if not files.exists(spark, f"{path}/{POINTER}"):
        return path
    version = f"{path}/{files.read_text(spark, f'{path}/{POINTER}').strip()}"
    if not files.exists(spark, version):
        raise JobFailed(f"{path}/{POINTER} names {version}, which does not exist")
    return version


def resolve_data(spark: SparkSession, path: str) -> str:
    version = resolve(spark, path)
    if not files.any_match(spark, f"{version}/train/*.parquet"):
        raise JobFailed(f"no parquet under {version}/train, prepare the data first")
    return version


def resolve_generation_inputs(
    spark: SparkSession, model_path: str, eval_path: str
) -> tuple[str, str]:
    """Immutable model and holdout versions; fails when either is missing."""
    model = resolve(spark, model_path)
    holdout = resolve(spark, eval_path)
    if not files.exists(spark, f"{holdout}/eval/_SUCCESS"):
        raise JobFailed(f"no finished holdout under {holdout}/eval, prepare the data first")
    return model, holdout


def read_train(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{version}/train")


def read_eval(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).option("mode", "FAILFAST").json(f"{version}/eval")
