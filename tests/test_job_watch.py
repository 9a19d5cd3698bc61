import datetime as dt
import random
import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F
from rows import collected, table

from pairmill.catalog.queries import QUERIES
from pairmill.operators.status import job_outcome
from pairmill.streaming.job_watch import JobWatch, latest_verdicts, minutes, watch_jobs

POLLS = (
    "job string, observed_at timestamp, seq bigint, deploy_status string, job_status string, "
    "reason string"
)
START = dt.datetime(2024, 3, 1)
TIMEOUT = 3600


def poll(job, seconds, status, seq=0, deploy="Running"):
    return (job, START + dt.timedelta(seconds=seconds), seq, deploy, status, f"{job}@{seconds}")


def watched(spark, folder, parts, **more):
    """Verdicts of a stream that gets the parts one after another."""
    for part in parts:
        table(spark, part, POLLS).coalesce(1).write.mode("append").parquet(f"{folder}/polls")
    stream = spark.readStream.schema(POLLS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/polls")
    run = (
        watch_jobs(stream, TIMEOUT, "30 seconds", **more).writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/verdicts")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/verdicts").where("job <> 'clock'")


def verdicts(found):
    rows = found.select("job", "told", "outcome", "silent", "reason").collect()
    return sorted(tuple(r) for r in rows)


def test_verdicts_as_they_come(spark, folder):
    found = watched(spark, folder, [
        [poll("good", 0, "RUNNING"), poll("silent", 10, "RUNNING"), poll("slow", 20, "RUNNING"),
         poll("tied", 30, "RUNNING"), poll("tied", 30, "FAILED", 1), poll("hung", 40, ""),
         poll("edge", 50, "RUNNING"), poll("gone", 55, "RUNNING", deploy="Failed")],
        [poll("good", 600, "SUCCEEDED"), poll("good", 700, "FAILED"), poll("hung", 50, "RUNNING")],
        [poll("clock", 3600 + 300, "RUNNING")],
        # The clock has passed all deadlines. One job turns out to have ended, one to run on.
        [poll("slow", 4000, "SUCCEEDED"), poll("hung", 4000, "RUNNING"),
         poll("edge", 50 + TIMEOUT, "RUNNING"), poll("edge", 4100, "STOPPED")],
        [poll("clock", 20_000, "RUNNING")],
    ])
    assert verdicts(found) == [
        ("edge", 1, "timeout", True, None), ("edge", 2, "failed", False, "edge@4100"),
        ("gone", 1, "deploy_failed", False, "gone@55"),
        ("good", 1, "success", False, "good@600"),
        ("hung", 1, "timeout", True, None), ("hung", 2, "timeout", False, None),
        ("silent", 1, "timeout", True, None),
        ("slow", 1, "timeout", True, None), ("slow", 2, "success", False, "slow@4000"),
        ("tied", 1, "failed", False, "tied@30"),
    ]
    last = {r["job"]: r["outcome"] for r in latest_verdicts(found).collect()}
    assert last["slow"] == "success" and last["hung"] == "timeout"
    when = {r["job"]: r for r in latest_verdicts(found).collect()}
    assert when["silent"]["decided_at"] - when["silent"]["first_at"] == dt.timedelta(seconds=TIMEOUT)


def test_verdicts_equal_the_batch_outcome(spark, folder):
    rng = random.Random(4)
    polls = []
    for job in range(40):
        at = rng.uniform(0, 600)
        for k in range(rng.randrange(1, 30)):
            status = rng.choices(["RUNNING", "", "SUCCEEDED", "FAILED"], [12, 3, 1, 1])[0]
            polls.append(poll(f"j{job}", at, status, k, rng.choice(["Running", "Running", "Failed"])
                              if rng.random() < 0.05 else "Running"))
            at += rng.choice([0, 0.001, 20, 200, 900])
    polls.sort(key=lambda p: p[1])
    third = len(polls) // 3
    parts = [polls[:third], polls[third : 2 * third], polls[2 * third :]]
    for part in parts:
        rng.shuffle(part)
    found = latest_verdicts(watched(spark, folder, [*parts, [poll("clock", 10**6, "RUNNING")]]))
    batch = job_outcome(table(spark, polls, POLLS), TIMEOUT)
    # A job that never ended and fell silent is a timeout for the clock.
    want = batch.select(
        "job", F.when(F.col("outcome") == "running", "timeout").otherwise(F.col("outcome")),
        "first_at", "reason",
    )
    assert collected(found.select("job", "outcome", "first_at", "reason").fillna("")) == collected(
        want.fillna(""))
    assert found.where("silent").count() == batch.where("outcome = 'running'").count() > 0


def test_the_watch_sees_one_row_per_job_and_minute(spark, folder):
    table(spark, [poll("a", s, "RUNNING", s) for s in range(150)], POLLS).write.parquet(folder)
    rows = minutes(spark.read.parquet(folder), "1 minute")
    assert rows.count() == 3
    first = rows.orderBy("minute").first()
    assert (first["open_us"] - first["first_us"], first["code"]) == (59_000_000, None)


def test_an_ended_job_is_forgotten_after_a_while(spark, folder):
    found = watched(spark, folder, [
        [poll("a", 0, "SUCCEEDED")], [poll("clock", 5000, "RUNNING")], [poll("a", 5100, "FAILED")],
        [poll("clock", 200_000, "RUNNING")], [poll("clock", 200_100, "RUNNING")],
        [poll("a", 300_000, "FAILED")], [poll("clock", 400_000, "RUNNING")],
    ], forget_seconds=90_000)
    assert [(r[0], r[2]) for r in verdicts(found)] == [("a", "failed"), ("a", "success")]


def test_the_processor_needs_no_package_where_it_is_opened():
    load = "import pickle, sys; print(pickle.load(sys.stdin.buffer).timeout_us)"
    run = subprocess.run(
        [sys.executable, "-I", "-c", load], input=cloudpickle.dumps(JobWatch(7)), cwd="/",
        capture_output=True,
    )
    assert (run.stdout, run.returncode) == (b"7000000\n", 0), run.stderr


def test_live_job_watch_in_a_session_without_its_settings(spark, folder):
    def event(number, seconds, user, kind):
        return (number, (START + dt.timedelta(seconds=seconds)).replace(tzinfo=None), user, kind, 1.0, f"p{number}")

    table(spark, [
        event(0, 0, 1, "signup"), event(1, 60, 1, "purchase"), event(2, 100, 2, "view"),
        event(3, 44_000, 2, "view"), event(4, 200, 3, "click"), event(5, 86_400, 4, "error"),
        event(6, 300, None, "view"), event(7, 400, None, "purchase"),
    ], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ).write.parquet(f"{folder}/events.parquet")
    provider = "spark.sql.streaming.stateStore.providerClass"
    own = spark.conf.get(provider)
    spark.conf.set(provider, own.replace("RocksDBStateStoreProvider", "HDFSBackedStateStoreProvider"))
    try:
        found = QUERIES["live_job_watch"](spark, folder)
        rows = {r["job"]: (r["outcome"], r["silent"], r["message"]) for r in found.collect()}
        assert "HDFS" in spark.conf.get(provider)
    finally:
        spark.conf.set(provider, own)
    assert rows == {
        "1": ("success", False, "p1"), "2": ("timeout", False, None), "3": ("timeout", True, None),
        "4": ("failed", False, "p5"), None: ("success", False, "p7"),
    }
