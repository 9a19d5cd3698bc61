"""The stream audit on an unbounded log, with the same verdicts as the batch audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.config import MIN_STREAM_SPAN_US, TRANSFER_LIMIT_S
from pairmill.functions.events import classify_lines
from pairmill.operators.audits import REPORT_COLUMNS, narrow_events, total_columns, verdict


def live_stream_audit(
    lines: DataFrame, lateness: str = "10 minutes", min_span_us: int = MIN_STREAM_SPAN_US,
    transfer_limit_s: int = TRANSFER_LIMIT_S,
) -> DataFrame:
    """One report per request of a streaming log, as soon as nothing of it can come any more.

    A request is a session: its lines are never further apart than one transfer may take, so the
    report is final, and emitted, once the watermark has passed the last line by that limit. Lines
    may come in any order and up to ``lateness`` behind the newest one; later ones are dropped.
    State is one row of counts per open request, in the JVM; a hot request is combined before the
    shuffle where sessions are merged locally, as the session settings ask for. A report without
    a close row is a failed transfer. The beginnings of the texts are no part of the state:
    ``stream_previews`` reads them from the log for the requests that need them.
    """
    events = narrow_events(classify_lines(lines.withWatermark("arrived_at", lateness)))
    session = F.session_window("arrived_at", f"{transfer_limit_s} seconds")
    totals = events.groupBy("request_id", session).agg(*total_columns())
    return totals.withColumn("verdict", verdict(min_span_us)).select(*REPORT_COLUMNS)
