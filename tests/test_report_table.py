import datetime as dt

import pytest
from rows import collected, table

from pairmill.operators import audits
from pairmill.operators.gate import acceptance_report
from pairmill.sources import files
from pairmill.streaming.report_table import ReportTable

LINES = "request_id string, seq bigint, arrived_at timestamp, line string, transfer_rc int"
START = dt.datetime(2024, 1, 1)


def said(text):
    return 'data: {"choices":[{"delta":{"content":"%s"}}]}' % text


def request(name, seconds, pieces, rc=0, ending=("data: [DONE]",)):
    """Lines of a request, the k-th after ``seconds[k]``, and its close row."""
    lines = [said(p) for p in pieces] + list(ending)
    rows = [(name, k, START + dt.timedelta(seconds=seconds[k]), line, None) for k, line in enumerate(lines)]
    last = rows[-1][2] + dt.timedelta(seconds=1)
    return rows + ([] if rc is None else [(name, len(lines), last, None, rc)])


REQUESTS = [
    *request("plain", [0, 1, 2], ["he", "llo"]),
    # Pauses for far longer than a transfer may take.
    *request("paused", [0, 1, 4000, 4001], ["a", "b", "c"]),
    *request("broken", [0, 1, 2], ["x"], ending=("data: {", "data: [DONE]")),
    *request("failed", [0, 5], ["x"], rc=28),
    *request("burst", [7, 7, 7], ["x", "y"]),
    *request("late", [3990, 4000], ["x"], rc=None),
    *request("lost", [0, 1], ["x"], rc=None),
]


def batches(spark, n=3):
    return [table(spark, REQUESTS[k::n], LINES) for k in range(n)]


def test_reports_equal_the_batch_audit_of_all_lines(spark, folder):
    reports = ReportTable(spark, folder)
    for number, lines in enumerate(batches(spark)):
        reports.apply(lines, number)
    found = reports.reports()
    want = audits.stream_audit(table(spark, REQUESTS, LINES))
    assert collected(found.drop("final")) == collected(want)
    # Open ones are final only after a silence.
    assert {r["request_id"]: r["final"] for r in found.collect() if not r["final"]} == {"late": False}


def test_a_batch_counts_once_whatever_happens_to_it(spark, folder, monkeypatch):
    reports = ReportTable(spark, folder)
    first, second, third = batches(spark)
    reports.apply(first, 0)
    before = collected(reports.reports())

    def fail(*_):
        raise RuntimeError("lost before the log")

    with monkeypatch.context() as broken:
        broken.setattr(files, "write_text_once", fail)
        with pytest.raises(RuntimeError):
            reports.apply(second, 1)
    # Not in the log, so not in the reports.
    assert collected(reports.reports()) == before and reports.logged() == {0}
    again = ReportTable(spark, folder)
    again.apply(second, 1)
    again.apply(second, 1)
    again.apply(first, 0)
    again.apply(third, 2)
    assert collected(again.reports().drop("final")) == collected(
        audits.stream_audit(table(spark, REQUESTS, LINES)))


def test_compaction_changes_no_report(spark, folder):
    reports = ReportTable(spark, folder)
    first, second, third = batches(spark)
    reports.apply(first, 0)
    reports.apply(second, 1)
    before = collected(reports.reports())
    reports.compact()
    assert collected(reports.reports()) == before
    reports.vacuum()
    assert collected(reports.reports()) == before
    assert files.names(spark, f"{folder}/fragments") == ["through=1"]
    # A batch that the compaction took in is known.
    reports.apply(first, 0)
    reports.apply(third, 2)
    reports.compact()
    reports.vacuum()
    assert collected(reports.reports().drop("final")) == collected(
        audits.stream_audit(table(spark, REQUESTS, LINES)))


def test_an_empty_table_has_no_reports(spark, folder):
    reports = ReportTable(spark, folder)
    assert collected(reports.reports()) == []
    reports.apply(table(spark, [], LINES), 0)
    assert collected(reports.reports()) == [] and reports.logged() == {0}


def test_a_stream_that_restarts_in_a_batch(spark, folder):
    for number, lines in enumerate(batches(spark)):
        lines.coalesce(1).write.mode("append").parquet(f"{folder}/lines")
    reports = ReportTable(spark, f"{folder}/table")
    stream = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/lines")

    def started(apply):
        return (
            stream.writeStream.foreachBatch(apply)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )

    def dies(batch, number):
        reports.apply(batch, number)
        if number == 1:
            raise RuntimeError("after the log, before the checkpoint")

    with pytest.raises(Exception, match="after the log"):
        started(dies).awaitTermination()
    started(reports.apply).awaitTermination()
    assert collected(reports.reports().drop("final")) == collected(
        audits.stream_audit(table(spark, REQUESTS, LINES)))


GENERATED = "g string, instruction string, reference string, generated string"


def test_a_sample_of_each_group(spark):
    # One group holds most rows, another fewer than the sample.
    rows = [("hot", f"q{i}", "r", "" if i % 4 == 0 else "a") for i in range(400)]
    rows += [("few", f"q{i}", "r", "a") for i in range(3)] + [(None, "q", "r", None)] * 2
    frame = table(spark, rows, GENERATED)
    found = {r["g"]: r for r in acceptance_report(frame, 50, 0.5, by=("g",)).collect()}
    assert {g: r["rows_checked"] for g, r in found.items()} == {"hot": 50, "few": 3, None: 2}
    assert found[None]["rows_unusable"] == 2 and not found[None]["passed"]
    assert found["few"]["empty_fraction"] == 0.0 and found["few"]["passed"]
    again = {r["g"]: r for r in acceptance_report(frame.repartition(9), 50, 0.5, by=("g",)).collect()}
    assert again == found
    # Without a group column the sample is that of the whole table.
    alone = acceptance_report(frame.where("g = 'hot'"), 50, 0.5).first()
    assert alone["rows_unusable"] == found["hot"]["rows_unusable"]
    plan = acceptance_report(frame, 50, by=("g",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
