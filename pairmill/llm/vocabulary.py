"""Vocabulary files on the driver, as broadcasts for the tasks."""

from __future__ import annotations

from pyspark import Broadcast
from pyspark.sql import SparkSession

from pairmill.sources.files import read_text


def broadcast_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes on every executor. A vocabulary is a fixed file of a few megabytes that
    does not grow with the data."""
    if "://" in path:
        content = read_text(spark, path).encode()
    else:
        with open(path, "rb") as file:
            content = file.read()
    return spark.sparkContext.broadcast(content)
