"""The jobs that go on where they last were, and the check of a version."""

import pytest
from rows import table
from test_job_watch import POLLS, poll
from test_report_table import LINES, REQUESTS

from pairmill import jobs
from pairmill.config import PrepConfig
from pairmill.errors import JobFailed
from pairmill.plans.prepare import prepare
from pairmill.sources import files
from pairmill.streaming.report_table import ReportTable


def run_job(spark, monkeypatch, job, **settings):
    for name, value in settings.items():
        monkeypatch.setenv(name, str(value))
    return jobs.JOBS[job](spark)


def test_reports_take_what_is_new(spark, folder, monkeypatch):
    settings = {"LOG_PATH": f"{folder}/log", "REPORT_PATH": f"{folder}/out"}
    for part in (REQUESTS[::2], REQUESTS[1::2]):
        table(spark, part, LINES).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        root = run_job(spark, monkeypatch, "reports", **settings)
    # Without new lines nothing changes.
    assert run_job(spark, monkeypatch, "reports", **settings) == root
    found = {r["request_id"]: r["verdict"] for r in ReportTable(spark, root).reports().collect()}
    assert found["plain"] == found["paused"] == "ok" and found["broken"] == "unparseable"
    assert found["burst"] == "buffered" and found["failed"] == "transfer_failed"


def test_watch_goes_on_where_it_was(spark, folder, monkeypatch):
    settings = {"LOG_PATH": f"{folder}/log", "REPORT_PATH": f"{folder}/out", "JOB_TIMEOUT": 3600}
    parts = (
        [poll("a", 0, "RUNNING"), poll("b", 5, "RUNNING")], [poll("a", 60, "SUCCEEDED")],
        [poll("clock", 20_000, "RUNNING")],
    )
    for part in parts:
        table(spark, part, POLLS).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        output = run_job(spark, monkeypatch, "watch", **settings)
    verdicts = spark.read.parquet(output).where("job <> 'clock'").select("job", "outcome", "silent")
    assert sorted(map(tuple, verdicts.collect())) == [("a", "success", False), ("b", "timeout", True)]


def test_check_fails_on_a_changed_version(spark, folder, monkeypatch):
    version = prepare(spark, PrepConfig(f"{folder}/raw", f"{folder}/data", "one", "base", max_len=300))
    assert run_job(spark, monkeypatch, "check", TOKENIZED_DIR=f"{folder}/data") == version
    spark.read.parquet(f"{version}/train").limit(1).write.mode("append").parquet(f"{version}/train")
    with pytest.raises(JobFailed, match="was changed"):
        run_job(spark, monkeypatch, "check", TOKENIZED_DIR=f"{folder}/data")
    assert files.exists(spark, f"{folder}/data/current")
