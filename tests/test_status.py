import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from rows import collected, table

from pairmill.catalog.oracle import OBSERVATIONS, ORACLE
from pairmill.operators import status

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = (
    "job string, observed_at timestamp, seq bigint, deploy_status string, job_status string"
)
TIMEOUT = 100

JOBS = {
    "success": [(0, "Initializing", ""), (10, "Running", "RUNNING"), (20, "Complete", "SUCCEEDED")],
    "failed": [(0, "Running", "RUNNING"), (10, "Complete", "FAILED")],
    "stopped": [(0, "Running", "RUNNING"), (10, None, "STOPPED")],
    "deploy_failed": [(0, "Initializing", ""), (10, "Failed", None)],
    "timeout": [(0, "Running", "RUNNING"), (101, "Running", "RUNNING")],
    "late_success": [(0, "Running", "RUNNING"), (500, "Complete", "SUCCEEDED")],
    "both": [(0, "Failed", "SUCCEEDED")],
    "running": [(0, "Running", "RUNNING"), (100, "Running", "RUNNING")],
    "timeout_then_success": [
        (0, "Running", "RUNNING"), (101, "Running", ""), (102, "Complete", "SUCCEEDED")
    ],
    "complete_only": [(0, "Complete", "")],
}
OUTCOMES = {
    "success": "success", "failed": "failed", "stopped": "failed",
    "deploy_failed": "deploy_failed", "timeout": "timeout", "late_success": "success",
    "both": "success", "running": "running", "timeout_then_success": "timeout",
    "complete_only": "running",
}


def rows_of(jobs):
    return [
        (job, START + dt.timedelta(seconds=t), i, d, s)
        for job, seen in jobs.items() for i, (t, d, s) in enumerate(seen)
    ]


def by_sql(name, rows):
    """The registered SQL over these observations."""
    observations = pd.DataFrame(  # noqa: F841
        [(j, t.replace(tzinfo=None), i, d, s, None, None) for j, t, i, d, s in rows],
        columns=["job", "observed_at", "seq", "deploy_status", "job_status", "reason", "message"],
    )
    observations = observations.astype(
        {c: "string" for c in ("job", "deploy_status", "job_status", "reason", "message")}
    )
    connection = duckdb.connect()
    connection.register("observations", observations)
    sql = ORACLE[name].replace(f"{OBSERVATIONS},", "").replace("43200", str(TIMEOUT))
    return connection.sql(sql).fetchall()


def random_jobs():
    draw = random.Random(11)
    jobs = {}
    for n in range(60):
        # The first job holds a third of all rows; times repeat and cross chunk borders.
        count = 600 if n == 0 else draw.randrange(1, 40)
        times = sorted(draw.randrange(0, 400) for _ in range(count))
        end = 0.002 if n == 0 else 0.06
        jobs[f"j{n}"] = [
            (t, draw.choice(["Running", "Initializing", "", None]),
             "SUCCEEDED" if draw.random() < end else draw.choice(["RUNNING", "", None]))
            for t in times
        ]
        if draw.random() < 0.3:
            t, _, _ = jobs[f"j{n}"][-1]
            jobs[f"j{n}"].append((t, "Failed", draw.choice(["", "FAILED", "STOPPED"])))
    return jobs


@pytest.mark.parametrize("chunk", [1, 7, 60, 100_000])
def test_outcomes(spark, chunk):
    got = status.job_outcome(table(spark, rows_of(JOBS), SCHEMA), TIMEOUT, chunk)
    assert dict(collected(got.select("job", "outcome"))) == OUTCOMES
    rows = rows_of(random_jobs())
    got = status.job_outcome(table(spark, rows, SCHEMA), TIMEOUT, chunk)
    assert collected(got.select("job", "outcome", "observations")) == sorted(
        r[:3] for r in by_sql("job_outcome", rows)
    )


def test_outcomes_tell_why(spark):
    rows = [(*r, f"r{r[2]}", f"m{r[2]}") for r in rows_of(JOBS)]
    log = table(spark, rows, SCHEMA + ", reason string, message string")
    got = {r["job"]: (r["reason"], r["message"]) for r in status.job_outcome(log, TIMEOUT).collect()}
    assert got["failed"] == ("r1", "m1") and got["success"] == ("r2", "m2")
    assert got["timeout"] == got["running"] == (None, None)


@pytest.mark.parametrize("chunk", [1, 7, 60, 100_000])
def test_changes(spark, chunk):
    rows = rows_of(JOBS | random_jobs())
    got = status.status_changes(table(spark, rows, SCHEMA), chunk)
    key = ("job", "seq", "previous", "state")
    assert sorted(map(str, collected(got.select(*key)))) == sorted(
        str((r[0], r[2], r[3], r[4])) for r in by_sql("status_changes", rows)
    )


def test_changes_of_a_job_with_a_third_of_all_rows_in_one_day(spark):
    rows = [
        ("hot", START + dt.timedelta(seconds=8 * i), i, "Running", "RUNNING" if i % 900 else "")
        for i in range(9000)
    ]
    got = status.status_changes(table(spark, rows, SCHEMA))
    assert sorted(map(str, collected(got.select("job", "seq", "previous", "state")))) == sorted(
        str((r[0], r[2], r[3], r[4])) for r in by_sql("status_changes", rows)
    )
    # Rows are dealt by minute, so the job's rows are in many tasks.
    shuffled = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(job" in shuffled and "_level0" in shuffled
