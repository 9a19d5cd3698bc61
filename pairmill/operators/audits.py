"""Audits of logged responses, event streams and model lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.config import MIN_STREAM_SPAN_US
from pairmill.functions import events as E
from pairmill.functions import variants as V
from pairmill.functions.text import nonblank
from pairmill.session import scratch_path

PREVIEW_CHARS = 120


def response_audit(responses: DataFrame, body: str = "body") -> DataFrame:
    """Adds the first failing check of a completion body, its length, a preview, the finish reason
    and, of a body that is unparseable or an error, its beginning."""
    keep = responses.columns
    parsed = responses.withColumn("_json", V.parse_guarded(F.col(body)))
    value = F.when(V.is_complete(F.col("_json"), F.col(body)), V.get(F.col("_json"), "$[0]"))
    first = "$[0].choices[0]"
    opened = parsed.select(
        *keep,
        F.substring(body, 1, E.EVIDENCE_CHARS).alias("_evidence"),
        V.is_kind(value, "OBJECT").alias("_object"),
        V.get(F.col("_json"), "$[0].error").isNotNull().alias("_error"),
        V.get(F.col("_json"), first).alias("_first"),
        V.get(F.col("_json"), f"{first}.message.content").alias("_content"),
        V.get(F.col("_json"), f"{first}.finish_reason").alias("_finish"),
    )
    content = F.col("_content")
    texts = opened.withColumn(
        "_text", F.when(V.is_kind(content, "STRING"), V.get(content, "$", "string"))
    )
    reason = (
        F.when(~F.col("_object"), "unparseable")
        .when(F.col("_error"), "error")
        .when(F.col("_first").isNull(), "no_choices")
        .when(~nonblank(F.col("_text")), "no_content")
        .when(~V.truthy(F.col("_finish")), "no_finish_reason")
        .otherwise("ok")
    )
    return texts.select(
        *[c for c in keep if c != body],
        reason.alias("reason"),
        F.length("_text").cast("bigint").alias("content_chars"),
        preview_of(F.col("_text")).alias("preview"),
        V.get(F.col("_finish"), "$", "string").alias("finish_reason"),
        F.when(reason.isin("unparseable", "error"), F.col("_evidence")).alias("evidence"),
    )


def preview_of(text: Column) -> Column:
    return F.replace(F.substring(text, 1, PREVIEW_CHARS), F.lit("\n"), F.lit(" "))


def model_listed(bodies: DataFrame, model_id: str, body: str = "body") -> DataFrame:
    """Adds whether the model list in ``body`` holds exactly this id."""
    data = F.from_json(body, "data array<struct<id string>>")["data"]
    listed = F.coalesce(F.exists(data, lambda m: m["id"] == model_id), F.lit(False))
    return bodies.withColumn("listed", listed).drop(body)


def narrow_events(events: DataFrame) -> DataFrame:
    """Of classified lines what totals and previews need: texts become a length and a beginning."""
    return events.select(
        "request_id", "seq", "arrived_at", "transfer_rc", "kind", "chunks",
        F.length("text").alias("chars"), F.substring("text", 1, PREVIEW_CHARS).alias("head"),
        "evidence",
    )


def total_columns() -> list[Column]:
    """The counts a verdict needs.

    All are of bounded width and combined before the shuffle, so a request holding a large part
    of all lines is one row per map task by then.
    """
    content = F.col("kind") == E.CONTENT
    bad = F.col("kind").isin(E.UNPARSEABLE, E.ERROR)
    arrived = F.when(content, F.unix_micros("arrived_at"))
    bad_seq = F.when(bad, F.col("seq"))
    return [
        F.max("transfer_rc").alias("transfer_rc"),
        F.min_by(F.when(bad, F.col("kind")), bad_seq).alias("bad_kind"),
        F.min_by("evidence", bad_seq).alias("evidence"),
        F.coalesce(F.bool_or(F.col("kind") == E.DONE), F.lit(False)).alias("done"),
        F.sum("chunks").cast("bigint").alias("chunks"),
        F.coalesce(F.sum("chars"), F.lit(0)).cast("bigint").alias("chars"),
        F.count_if(F.col("kind") == E.PROTOCOL).alias("protocol_frames"),
        (F.max(arrived) - F.min(arrived)).alias("span_us"),
    ]


def stream_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("request_id").agg(*total_columns())


def stream_previews(events: DataFrame) -> DataFrame:
    """The joined text's first characters, per request.

    Content lines are not empty, so the first 120 of them hold the first 120 characters; the rank
    limit is applied before the shuffle as well as after it.
    """
    first = Window.partitionBy("request_id").orderBy("seq")
    lines = (
        events.where(F.col("kind") == E.CONTENT).select("request_id", "seq", "head")
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= PREVIEW_CHARS)
    )
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("seq", "head")))["head"], "")
    return lines.groupBy("request_id").agg(preview_of(joined).alias("preview"))


def staged_events(lines: DataFrame) -> DataFrame:
    """Narrow events of a log, written once to the shared folder.

    A condition on what a line was classified as would otherwise move below the classification and
    parse every line several times.
    """
    staged = scratch_path(lines.sparkSession, "events")
    narrow_events(E.classify_lines(lines)).write.parquet(staged)
    return lines.sparkSession.read.parquet(staged)


def with_previews(reports: DataFrame, lines: DataFrame) -> DataFrame:
    """Reports of requests with the beginnings of their texts, looked up in the log."""
    wanted = lines.join(reports.select("request_id"), "request_id", "left_semi")
    return reports.join(stream_previews(staged_events(wanted)), "request_id", "left")


def verdict(min_span_us: int = MIN_STREAM_SPAN_US) -> Column:
    """The first rule a stream breaks.

    Transfer, then the earliest bad line, then completeness, then content, then incremental
    arrival, which a single chunk cannot show.
    """
    return (
        F.when(F.coalesce(F.col("transfer_rc") != 0, F.lit(True)), "transfer_failed")
        .when(F.col("bad_kind") == E.UNPARSEABLE, "unparseable")
        .when(F.col("bad_kind") == E.ERROR, "error_event")
        .when(~F.col("done"), "no_done")
        .when(F.col("chunks") == 0, "no_content")
        .when((F.col("chunks") > 1) & (F.col("span_us") < min_span_us), "buffered")
        .otherwise("ok")
    )


REPORT_COLUMNS = (
    "request_id", "verdict", "chunks", "chars", "protocol_frames", "span_us", "evidence",
)


def stream_audit(
    lines: DataFrame, min_span_us: int = MIN_STREAM_SPAN_US, with_preview: bool = True
) -> DataFrame:
    """Judges every request in a log of (request_id, seq, arrived_at, line, transfer_rc).

    The last row of a request has no line but the exit code of its transfer; without one the
    transfer counts as failed. With previews the classified lines are written once to the shared
    folder, so that the log is read and parsed once for both.
    """
    events = staged_events(lines) if with_preview else narrow_events(E.classify_lines(lines))
    report = stream_totals(events).withColumn("verdict", verdict(min_span_us))
    report = report.select(*REPORT_COLUMNS)
    if not with_preview:
        return report
    return report.join(stream_previews(events), "request_id", "left")
