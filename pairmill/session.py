"""Session settings the jobs are meant to run with, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What streams with state need; a stream keeps what its session had when it was started.
STREAM_SETTINGS = {
    # Open requests of a stream live on disk with their changes logged, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Lines of one request are combined on the map side before its session is shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Texts can be long, so Arrow batches are kept short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    **STREAM_SETTINGS,
    # A JSON object naming a key twice is accepted and the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: list[str] = []
ONE_MACHINE = re.compile(r"local(\[.*\])?$")


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps intermediate tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not ONE_MACHINE.match(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="pairmill-"))
            atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
        root = _local_scratch[0]
    return f"{root.rstrip('/')}/pairmill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder the cluster names for checkpoints.

    Intermediate tables are written there, not kept on executors, so they outlive the loss of any
    executor. Only a session on one machine may fall back to a temporary folder of it, which is
    removed at exit.
    """
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application, once its results are elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(rows: DataFrame) -> int | None:
    """Estimated size of all tables a DataFrame reads; None when some input has no estimate."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size >= 1 << 62 for size in sizes) else sum(sizes)


# What one task of a shuffle should get, and the partitions for an input of unknown size: too many
# are merged, too few cannot be split.
SHUFFLE_BYTES = 128 << 20
UNKNOWN_PARTITIONS = 20_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def _with_conf(spark: SparkSession, settings: dict[str, str]):
    """While open, the session has these settings."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Rows of a stream's log that one file, and one partition of its state, should get.
STREAM_ROWS = 100_000


def stream_parts(rows: int, least: int = 1) -> int:
    """In how many files or partitions so many rows of a log go."""
    return max(least, -(-rows // STREAM_ROWS))


@contextmanager
def stream_settings(spark: SparkSession, rows: int = 0):
    """While open, streams start with what state needs, and with partitions for so many rows.

    A session may come without them, and a stream cannot split or merge its partitions later.
    """
    parts = stream_parts(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with _with_conf(spark, {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": str(parts)}):
        yield


@contextmanager
def sized_shuffles(rows: DataFrame, growth: float = 1.0):
    """While open, shuffles start with enough partitions for the input times ``growth``.

    Adaptive execution merges partitions that turn out small but cannot split what a fixed
    number of them made too large.
    """
    spark = rows.sparkSession
    size = input_bytes(rows)
    wanted = UNKNOWN_PARTITIONS if size is None else int(size * growth) // SHUFFLE_BYTES
    if wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    with _with_conf(spark, {INITIAL_PARTITIONS: wanted}):
        yield


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once per application.

    The driver packs it; Spark itself carries the archive to every executor, also to those that
    join later.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="pairmill-"), "pairmill"), "zip",
        os.path.dirname(home), os.path.basename(home),
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
