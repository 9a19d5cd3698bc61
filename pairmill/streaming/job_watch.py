"""Jobs judged while they run: a verdict as soon as one can be told, a timeout also without a row.

First the polls of a job are put together by the minute, so the watch sees one row per job and minute
and in order, however often a job is polled and however its polls arrive. Then the state of a job,
a few numbers, is carried from minute to minute by a processor with event-time timers.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pairmill.operators.status import DEPLOY_FAILED, FAILED, SUCCEEDED, terminal_code

# Spark first opens the processor in a worker beside the driver, which gets no shipped package, so it
# travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTCOMES = {SUCCEEDED: "success", FAILED: "failed", DEPLOY_FAILED: "deploy_failed"}
STATE = "first_us bigint, told int, ended boolean"
VERDICT = (
    "job {kind}, outcome string, first_at timestamp, decided_at timestamp, silent boolean, "
    "told int, reason string, message string"
)
# A job that has ended is known for so long, in which rows of it change nothing.
FORGET_SECONDS = 30 * 86_400


def minutes(observations: DataFrame, lateness: str, minute: str = "1 minute") -> DataFrame:
    """One row per job and minute: its first and last poll, its first terminal poll, and the last one
    before that.

    The polls of one job in one minute are held together until the watermark has passed it.
    """
    told = [
        (F.col(c) if c in observations.columns else F.lit(None)).cast("string").alias(c)
        for c in ("reason", "message")
    ]
    poll = F.struct("observed_at", F.col("seq").cast("bigint").alias("seq"), "code", *told)
    coded = observations.withColumns(
        {"code": terminal_code(), "observed_at": F.col("observed_at").cast("timestamp")}
    ).withWatermark("observed_at", lateness)
    polls = coded.groupBy("job", F.window("observed_at", minute)).agg(
        F.array_sort(F.collect_list(poll)).alias("polls")
    )
    ended = F.filter("polls", lambda p: p["code"].isNotNull())[0]
    opened = polls.select(
        "job", F.window_time("window").alias("minute"), "polls",
        F.when(F.exists("polls", lambda p: p["code"].isNotNull()), ended).alias("end"),
    )
    before = F.filter(
        "polls", lambda p: F.col("end").isNull()
        | (F.struct(p["observed_at"], p["seq"]) < F.struct(F.col("end.observed_at"), F.col("end.seq")))
    )
    return opened.select(
        "job", "minute",
        F.unix_micros(F.col("polls")[0]["observed_at"]).alias("first_us"),
        F.array_max(F.transform(before, lambda p: F.unix_micros(p["observed_at"]))).alias("open_us"),
        F.unix_micros("end.observed_at").alias("end_us"),
        "end.code", "end.reason", "end.message",
    )


def _at(micros: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(micros / 1_000_000, dt.timezone.utc)


class JobWatch(StatefulProcessor):
    """Follows one job: its first poll, how many verdicts it got, and whether that is all."""

    def __init__(self, timeout_seconds: int, forget_seconds: int = FORGET_SECONDS):
        self.timeout_us = timeout_seconds * 1_000_000
        self.forget_ms = forget_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, told, ended = self.state.get() if self.state.exists() else (None, 0, False)
        if ended:
            return
        for row in sorted(rows, key=lambda r: r["first_us"]):
            if first is None:
                first = row["first_us"]
                # The clock of the log may pass the deadline without any poll of this job.
                self.handle.registerTimer((first + self.timeout_us) // 1000 + 1)
            deadline = first + self.timeout_us
            if row["open_us"] is not None and row["open_us"] > deadline:
                ended, told = True, told + 1
                yield self.verdict(key, "timeout", first, row["open_us"], False, told)
            elif row["code"] is not None:
                ended, told = True, told + 1
                yield self.verdict(
                    key, OUTCOMES[row["code"]], first, row["end_us"], False, told, row)
            if ended:
                self.handle.registerTimer(row["first_us"] // 1000 + self.forget_ms)
                break
        self.state.update((first, told, ended))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        first, told, ended = self.state.get()
        deadline = (first + self.timeout_us) // 1000 + 1
        if ended and expiredTimerInfo.getExpiryTimeInMs() != deadline:
            self.state.clear()
        elif not ended and told == 0:
            # Nothing terminal came, but a late poll may still find the job ended.
            self.state.update((first, 1, False))
            yield self.verdict(key, "timeout", first, first + self.timeout_us, True, 1)

    def verdict(self, key, outcome, first, decided, silent, told, row=None) -> Row:
        return Row(
            job=key[0], outcome=outcome, first_at=_at(first), decided_at=_at(decided), silent=silent,
            told=told, reason=row["reason"] if row else None, message=row["message"] if row else None,
        )


def watch_jobs(
    observations: DataFrame, timeout_seconds: int, lateness: str = "10 minutes",
    forget_seconds: int = FORGET_SECONDS,
) -> DataFrame:
    """Verdicts on the jobs of a streaming log, by the rules of ``job_outcome``.

    A job gets its verdict once the watermark has passed the minute that decides it. If none came by
    its deadline it gets a ``silent`` timeout then, without a row of its own; should its next poll
    find it ended, as a slow poll may, a second verdict (``told`` 2) says so. Polls later than the
    watermark allows are dropped. ``forget_seconds`` after its last verdict a job's state is removed.
    Timers need a state store with column families: start the stream inside ``stream_settings``
    where the session was not made by ``build_session``.
    """
    kind = observations.schema["job"].dataType.simpleString()
    return minutes(observations, lateness).groupBy("job").transformWithState(
        JobWatch(timeout_seconds, forget_seconds), VERDICT.format(kind=kind), "Append", "EventTime",
    )


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """The last word on each job."""
    columns = [c for c in verdicts.columns if c not in ("job", "told")]
    last = F.max_by(F.struct(*columns), "told").alias("last")
    return verdicts.groupBy("job").agg(last).select("job", "last.*")
