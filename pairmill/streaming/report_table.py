"""A table of stream reports that is right after every batch, whatever was repeated or cut short.

Each micro-batch of the log leaves one fragment per request: counts that can be added to those of other
fragments of the request. A fragment goes into a folder named after its batch, and the batch into a
log of its own, by a file that is created only if absent, once the folder is complete. A batch that
is run again after a failure replaces its folder; one that is in the log already does nothing. What
the log does not name is never read.

Reports are made when they are read, by adding up a request's fragments. So a request has one report however
long it pauses and however its lines are spread over batches, lines are never too late, and the stream
keeps no state. ``compact`` adds up what there is, so that reading does not grow with the number of
batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.config import MIN_STREAM_SPAN_US, TRANSFER_LIMIT_S
from pairmill.functions import events as E
from pairmill.operators.audits import (
    PREVIEW_CHARS, REPORT_COLUMNS, narrow_events, preview_of, verdict,
)
from pairmill.sources import files

FRAGMENT = (
    "request_id string, transfer_rc int, bad struct<seq: bigint, kind: int, evidence: string>, "
    "done boolean, chunks bigint, chars bigint, protocol_frames bigint, first_us bigint, "
    "last_us bigint, seen_us bigint"
)
HEAD = "request_id string, seq bigint, head string"


def fragments(events: DataFrame) -> DataFrame:
    """One row per request of narrow events; all columns can be merged."""
    content = F.col("kind") == E.CONTENT
    bad = F.col("kind").isin(E.UNPARSEABLE, E.ERROR)
    arrived = F.unix_micros("arrived_at")
    return events.groupBy("request_id").agg(
        F.max("transfer_rc").alias("transfer_rc"),
        F.min(F.when(bad, F.struct(F.col("seq").cast("bigint"), "kind", "evidence"))).alias("bad"),
        F.bool_or(F.col("kind") == E.DONE).alias("done"),
        F.sum("chunks").cast("bigint").alias("chunks"),
        F.coalesce(F.sum("chars"), F.lit(0)).cast("bigint").alias("chars"),
        F.count_if(F.col("kind") == E.PROTOCOL).alias("protocol_frames"),
        F.min(F.when(content, arrived)).alias("first_us"),
        F.max(F.when(content, arrived)).alias("last_us"),
        F.max(arrived).alias("seen_us"),
    )


def merged_fragments(parts: DataFrame) -> DataFrame:
    return parts.groupBy("request_id").agg(
        F.max("transfer_rc").alias("transfer_rc"),
        F.min("bad").alias("bad"),
        F.bool_or("done").alias("done"),
        *[F.sum(c).alias(c) for c in ("chunks", "chars", "protocol_frames")],
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.max("seen_us").alias("seen_us"),
    )


def first_heads(heads: DataFrame) -> DataFrame:
    """Of each request the content lines that can hold the first characters of its text."""
    first = Window.partitionBy("request_id").orderBy("seq")
    ranked = heads.withColumn("_rank", F.row_number().over(first))
    return ranked.where(F.col("_rank") <= PREVIEW_CHARS).drop("_rank")


class ReportTable:
    """Fragments of requests below a folder, by batch; use ``apply`` with ``foreachBatch``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _batch(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch={batch_id}"

    def apply(self, lines: DataFrame, batch_id: int) -> None:
        """Adds the lines of a batch, once however often it is called for it."""
        if batch_id in self.logged():
            return
        # The log is parsed once, for the counts and for the beginnings of the texts.
        staged = self._batch("events", batch_id)
        narrow_events(E.classify_lines(lines)).write.mode("overwrite").parquet(staged)
        events = self.spark.read.parquet(staged)
        fragments(events).write.mode("overwrite").parquet(self._batch("fragments", batch_id))
        content = events.where(F.col("kind") == E.CONTENT).select(
            "request_id", F.col("seq").cast("bigint").alias("seq"), "head"
        )
        first_heads(content).write.mode("overwrite").parquet(self._batch("heads", batch_id))
        files.write_text_once(self.spark, f"{self.root}/log/{batch_id}", str(batch_id))
        files.remove(self.spark, staged)

    def logged(self) -> set[int]:
        names = files.names(self.spark, f"{self.root}/log")
        through = self._compacted()
        return {int(n) for n in names if n.isdigit()} | set(range(through + 1))

    def _compacted(self) -> int:
        """The batch up to which everything is in the compacted folder; -1 without one."""
        names = files.names(self.spark, f"{self.root}/compacted")
        return max((int(n) for n in names if n.isdigit()), default=-1)

    def _read(self, kind: str, schema: str) -> DataFrame:
        through = self._compacted()
        paths = [f"{self.root}/{kind}/through={through}"] if through >= 0 else []
        paths += [self._batch(kind, b) for b in sorted(self.logged()) if b > through]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def compact(self) -> None:
        """Adds up all batches without a gap; reading goes on from the old folders until it is done.

        The old folders stay until ``vacuum``, for those who are reading them.
        """
        logged, through = self.logged(), self._compacted()
        last = through
        while last + 1 in logged:
            last += 1
        if last == through:
            return
        for kind, schema, merge in (
            ("fragments", FRAGMENT, merged_fragments), ("heads", HEAD, first_heads)
        ):
            paths = [f"{self.root}/{kind}/through={through}"] if through >= 0 else []
            paths += [self._batch(kind, b) for b in range(through + 1, last + 1)]
            rows = self.spark.read.schema(schema).parquet(*paths)
            merge(rows).write.mode("overwrite").parquet(f"{self.root}/{kind}/through={last}")
        files.write_text_once(self.spark, f"{self.root}/compacted/{last}", str(last))

    def vacuum(self) -> None:
        """Removes folders that the last compaction replaced."""
        through = self._compacted()
        for kind in ("fragments", "heads"):
            for name in files.names(self.spark, f"{self.root}/{kind}"):
                label, _, number = name.partition("=")
                old = (label == "batch" and int(number) <= through) or (
                    label == "through" and int(number) < through)
                if old:
                    files.remove(self.spark, f"{self.root}/{kind}/{name}")

    def reports(
        self, min_span_us: int = MIN_STREAM_SPAN_US, transfer_limit_s: int = TRANSFER_LIMIT_S
    ) -> DataFrame:
        """One report per request, and whether it is final.

        It is once the request has been closed, or has been silent for as long as a transfer may take,
        seen from the newest line of the table.
        """
        merged = merged_fragments(self._read("fragments", FRAGMENT))
        newest = merged.agg(F.max("seen_us"))
        silent = newest.scalar() - F.col("seen_us") > transfer_limit_s * 1_000_000
        told = merged.select(
            "*", F.col("bad.kind").alias("bad_kind"), F.col("bad.evidence").alias("evidence"),
            (F.col("last_us") - F.col("first_us")).alias("span_us"),
            (F.col("transfer_rc").isNotNull() | silent).alias("final"),
        ).withColumn("verdict", verdict(min_span_us))
        heads = first_heads(self._read("heads", HEAD))
        text = F.array_join(F.array_sort(F.collect_list(F.struct("seq", "head")))["head"], "")
        previews = heads.groupBy("request_id").agg(preview_of(text).alias("preview"))
        return told.select(*REPORT_COLUMNS, "final").join(previews, "request_id", "left")
