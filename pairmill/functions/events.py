"""Lines of a server-sent event stream, classified."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.functions import variants as V
from pairmill.functions.text import strip

IGNORED, DONE, UNPARSEABLE, ERROR, CONTENT, PROTOCOL = range(6)
MARKER = "data: "
# Characters of a broken payload that a report shows.
EVIDENCE_CHARS = 200
# What a frame is read as; a part of another shape is null in it.
FRAME = "struct<error variant, choices array<struct<delta struct<content variant>>>>"


def _misshapen(choice: Column) -> Column:
    """A choice, or its delta, that is not an object where one is needed."""
    delta = V.get(choice, "$.delta")
    absent = V.is_kind(choice, "OBJECT") & (delta.isNull() | ~V.truthy(delta))
    return ~(V.is_kind(delta, "OBJECT") | absent)


def _text(content: Column) -> Column:
    return F.when(V.is_kind(content, "STRING"), V.get(content, "$", "string"))


def _payloads(lines: DataFrame, line: str, keep: list[str]) -> DataFrame:
    stripped = lines.select(*keep, strip(F.col(line)).alias("_line"))
    behind = strip(F.expr(f"substring(_line, {len(MARKER) + 1})"))
    return stripped.select(
        *keep, F.when(F.col("_line").startswith(MARKER), behind).alias("_payload")
    )


def classify_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Replaces ``line`` by ``kind``, ``chunks`` (content pieces in it), their joined ``text`` and
    ``evidence``, the beginning of a payload that is unparseable or an error.

    Each step is its own projection, so the JSON of a line is parsed once. Nearly every event has
    one choice with a delta and is read by a single extraction; any other goes through the list
    functions, which also tell what is merely empty from what has the wrong shape.
    """
    keep = [c for c in lines.columns if c != line]
    parsed = _payloads(lines, line, keep).select(
        *keep, "_payload", V.parse_guarded(F.col("_payload")).alias("_json")
    )
    framed = parsed.select(
        *keep,
        "_payload",
        "_json",
        F.when(V.is_complete(F.col("_json"), F.col("_payload")), V.get(F.col("_json"), "$[0]", FRAME)).alias("_frame"),
    )
    # No object at all, or one with an error, settles the kind.
    early = (
        F.when(F.col("_payload").isNull(), IGNORED)
        .when(F.col("_payload") == "[DONE]", DONE)
        .when(F.col("_frame").isNull(), UNPARSEABLE)
        .when(F.col("_frame.error").isNotNull(), ERROR)
    )
    delta = F.get("_frame.choices", F.lit(0))["delta"]
    plain = (F.size("_frame.choices") == 1) & delta.isNotNull()
    opened = framed.select(
        *keep,
        early.alias("_early"),
        F.substring("_payload", 1, EVIDENCE_CHARS).alias("_evidence"),
        F.coalesce(plain, F.lit(False)).alias("_plain"),
        delta["content"].alias("_content"),
        F.when(early.isNull() & ~F.coalesce(plain, F.lit(False)), F.col("_json")).alias("_json"),
    )
    listed = V.get(F.col("_json"), "$[0].choices")
    choices = V.get(F.col("_json"), "$[0].choices", "array<variant>")
    # Only an empty object or text can stand in for a missing list without being an error.
    no_list = (
        listed.isNotNull()
        & choices.isNull()
        & (F.schema_of_variant(listed) != "OBJECT<>")
        & ~F.coalesce(V.get(listed, "$", "string") == "", F.lit(False))
    )
    wrong = no_list | F.coalesce(F.exists(choices, _misshapen), F.lit(False))
    texts = F.transform(choices, lambda c: _text(V.get(c, "$.delta.content")))
    pieces = opened.select(
        *keep,
        "_early",
        "_evidence",
        "_plain",
        F.when(~F.col("_plain") & F.col("_early").isNull(), wrong).alias("_wrong"),
        F.when(F.col("_plain"), F.nullif(_text(F.col("_content")), F.lit(""))).alias("_piece"),
        F.when(
            ~F.col("_plain") & F.col("_early").isNull(),
            F.filter(texts, lambda p: p.isNotNull() & (p != "")),
        ).alias("_pieces"),
    )
    chunks = F.when(F.col("_plain"), F.col("_piece").isNotNull().cast("int")).otherwise(
        F.coalesce(F.size("_pieces"), F.lit(0))
    )
    kind = F.coalesce(
        "_early",
        F.when(F.col("_wrong"), UNPARSEABLE).when(F.col("_chunks") > 0, CONTENT),
        F.lit(PROTOCOL),
    )
    classified = pieces.withColumn("_chunks", chunks).select(
        *keep, kind.alias("kind"), "_chunks", "_piece", "_pieces", "_evidence"
    )
    content = F.col("kind") == CONTENT
    text = F.coalesce(F.col("_piece"), F.array_join("_pieces", ""))
    return classified.select(
        *keep,
        "kind",
        F.when(content, F.col("_chunks")).otherwise(0).alias("chunks"),
        F.when(content, text).alias("text"),
        F.when(F.col("kind").isin(UNPARSEABLE, ERROR), F.col("_evidence")).alias("evidence"),
    )
