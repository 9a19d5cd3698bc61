"""Logs of polled job states: what changed, and how each job ended.

Both need the observation before each one. A job polled for very long or very often may hold a
large part of all rows, so observations are ordered inside minutes, which spread over tasks; the
ends of minutes are ordered inside days, and only the ends of days across them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.operators.neighbours import with_previous

CHUNK_SECONDS = 60
# Chunks in a chunk of the second level.
SPAN_CHUNKS = 1440
SUCCEEDED, FAILED, DEPLOY_FAILED = 1, 2, 3


def _chunk(observations: DataFrame, seconds: int) -> Column:
    """Number of the time chunk; never decreases with time, whatever the session's time zone."""
    if dict(observations.dtypes)["observed_at"] == "timestamp_ntz":
        micros = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', observed_at)"
    else:
        micros = "unix_micros(observed_at)"
    return F.expr(f"{micros} div {seconds * 1_000_000}")


def _shown(status: str) -> Column:
    return F.coalesce(F.nullif(F.col(status), F.lit("")), F.lit("?"))


def status_changes(observations: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Observations whose (deployment/job) state differs from the one before, blank shown as ?."""
    states = observations.select(
        "job", "observed_at", "seq",
        F.concat_ws("/", _shown("deploy_status"), _shown("job_status")).alias("state"),
    )
    seconds = (chunk_seconds, chunk_seconds * SPAN_CHUNKS)
    changed = with_previous(
        states, "job", ["observed_at", "seq"], [_chunk(observations, n) for n in seconds],
        F.col("state"), wanted=lambda rows: rows.where(~F.col("state").eqNullSafe(F.col("previous"))),
    )
    return changed.select("job", "observed_at", "seq", "previous", "state")


def terminal_code() -> Column:
    """How an observation ends its job, null while it runs; the job's own state is looked at first."""
    job, deploy = F.col("job_status"), F.col("deploy_status")
    return (
        F.when(job == "SUCCEEDED", SUCCEEDED)
        .when(job.isin("FAILED", "STOPPED"), FAILED)
        .when(deploy == "Failed", DEPLOY_FAILED)
    )


def job_outcome(
    observations: DataFrame, timeout_seconds: int, chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """How each job ended: success, failed, deploy_failed, timeout or running.

    The first terminal observation decides, unless an earlier one was already past the deadline,
    ``timeout_seconds`` after the first observation. The job's own state is looked at before the
    deployment's, and both before the clock. Columns ``reason`` and ``message`` of the deciding
    observation are returned if the log has them.
    """
    told = [c for c in ("reason", "message") if c in observations.columns]
    rows = observations.select(
        "job", "observed_at", "seq", terminal_code().alias("code"), *told,
        _chunk(observations, chunk_seconds).alias("_chunk"),
    )
    inside = Window.partitionBy("job", "_chunk").orderBy("observed_at", "seq")
    terminal = F.when(F.col("code").isNotNull(), F.struct("observed_at", "seq", "code", "_before", *told))
    chunks = (
        rows.withColumn("_before", F.lag("observed_at").over(inside))
        .groupBy("job", "_chunk")
        .agg(
            F.min("observed_at").alias("first_at"),
            F.max("observed_at").alias("last_at"),
            F.count(F.lit(1)).alias("observations"),
            F.min(terminal).alias("_terminal"),
        )
    )
    chunks = with_previous(
        chunks, "job", ["_chunk"], [F.expr(f"_chunk div {SPAN_CHUNKS}")], F.col("last_at")
    ).withColumn("_before", F.coalesce("_terminal._before", "previous"))
    ended = F.when(
        F.col("_terminal").isNotNull(),
        F.struct(
            F.col("_terminal.observed_at").alias("at"), F.col("_terminal.code").alias("code"),
            F.col("_before").alias("before"), *[F.col(f"_terminal.{c}") for c in told],
        ),
    )
    jobs = chunks.groupBy("job").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.sum("observations").alias("observations"),
        F.min_by(ended, F.when(ended.isNotNull(), F.col("_chunk"))).alias("_end"),
    )
    deadline = F.col("first_at") + F.expr(f"make_dt_interval(0, 0, 0, {timeout_seconds})")
    last_open = F.when(F.col("_end").isNull(), F.col("last_at")).otherwise(F.col("_end.before"))
    outcome = (
        F.when(F.coalesce(last_open > deadline, F.lit(False)), "timeout")
        .when(F.col("_end.code") == SUCCEEDED, "success")
        .when(F.col("_end.code") == FAILED, "failed")
        .when(F.col("_end.code") == DEPLOY_FAILED, "deploy_failed")
        .otherwise("running")
    )
    decided = ~outcome.isin("timeout", "running")
    return jobs.select(
        "job", outcome.alias("outcome"), "observations", "first_at", "last_at",
        *[F.when(decided, F.col(f"_end.{c}")).alias(c) for c in told],
    )
