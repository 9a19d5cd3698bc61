"""Versions are created once, filled, and only then pointed at."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from pairmill.errors import JobFailed
from pairmill.sources import files
from pairmill.sources.versions import POINTER


def claim_version(spark: SparkSession, root: str, name: str) -> str:
    """Creates ``root/name`` for this run alone; an existing version is never reused.

    The claim is one create-if-absent of a marker file, so of two runs with the same id only one
    goes on.
    """
    version = f"{root.rstrip('/')}/{name}"
    taken = f"version {version} already exists"
    if files.exists(spark, version):
        raise JobFailed(taken)
    try:
        files.write_text(spark, f"{version}/_claimed", name)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            raise JobFailed(taken) from error
        raise
    return version


def publish(spark: SparkSession, version: str) -> None:
    """Points ``current`` at a finished version in one step; older versions stay for rollback.

    File systems without an atomic rename get a single overwriting put instead.
    """
    root, name = version.rsplit("/", 1)
    staged = f"{root}/.{POINTER}-{name}"
    files.write_text(spark, staged, name, overwrite=True)
    try:
        files.replace(spark, staged, f"{root}/{POINTER}")
    except Py4JJavaError as error:
        if "UnsupportedFileSystem" not in str(error.java_exception):
            raise
        files.write_text(spark, f"{root}/{POINTER}", name, overwrite=True)
        files.remove(spark, staged)


def write_train(rows: DataFrame, version: str) -> None:
    rows.write.mode("errorifexists").parquet(f"{version}/train")


def write_eval(rows: DataFrame, version: str) -> None:
    """The holdout as JSON lines, written by the tasks that hold it."""
    rows.select("instruction", "response").write.mode("errorifexists").option(
        "ignoreNullFields", "false"
    ).json(f"{version}/eval")


def write_record(spark: SparkSession, record: dict, schema: str, path: str) -> DataFrame:
    """A one-row JSON record: manifest, acceptance report or provenance."""
    row = spark.createDataFrame([record], schema)
    row.coalesce(1).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return row
