"""The jobs from the command line, configured by environment variables.

    spark-submit ... pairmill/jobs.py JOB

prepare, batches, infer and export follow a data set to a model, and check compares the current
version with the fingerprints in its manifest; audit-streams, audit-responses, audit-models, status
and capacity judge a table of logs (LOG_PATH), write a report (REPORT_PATH) and then fail if more than
MAX_FAILING rows fail. reports and watch take what is new in a growing LOG_PATH since they last ran:
the one adds it to a table of stream reports below REPORT_PATH, the other appends verdicts on jobs.

Settings are named like the fields of the configuration classes in upper case. Besides them
TOKENIZER_JSON, EOS_TOKEN and PAD_TOKEN choose a tokenizer file, BATCHES_DIR is where batches are
laid out, GENERATOR names the model loader as module:function, and CHECKPOINTS_PATH the table of
checkpoints to export from.
"""

from __future__ import annotations

import importlib
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pairmill.config import AuditConfig, GenConfig, PrepConfig, TrainConfig  # noqa: E402
from pairmill.errors import JobFailed  # noqa: E402
from pairmill.functions.tokens import FileTokenizer  # noqa: E402
from pairmill.operators import audits, capacity, status  # noqa: E402
from pairmill.operators.gate import preview  # noqa: E402
from pairmill.plans.handoff import export_run, write_batches  # noqa: E402
from pairmill.plans.inference import check_context, read_generated, run_inference  # noqa: E402
from pairmill.plans.prepare import check_version, prepare  # noqa: E402
from pairmill.session import build_session, clear_scratch  # noqa: E402
from pairmill.sources import versions  # noqa: E402
from pairmill.streaming.job_watch import watch_jobs  # noqa: E402
from pairmill.streaming.report_table import ReportTable  # noqa: E402


def run_prepare(spark) -> str:
    path = os.environ.get("TOKENIZER_JSON")
    tokenizer = path and FileTokenizer(
        spark, path, os.environ["EOS_TOKEN"], os.environ.get("PAD_TOKEN")
    )
    return prepare(spark, PrepConfig.from_env(), tokenizer=tokenizer)


def run_batches(spark) -> str:
    return write_batches(spark, TrainConfig.from_env(), os.environ["BATCHES_DIR"])


def run_infer(spark) -> str:
    module, function = os.environ["GENERATOR"].split(":")
    load_model = getattr(importlib.import_module(module), function)
    config = GenConfig.from_env()
    check_context(config, PrepConfig.from_env().max_len)
    output = run_inference(spark, config, load_model)
    for row in preview(read_generated(spark, output)).collect():
        print(json.dumps(row.asDict(), ensure_ascii=False, indent=2), file=sys.stderr)
    return output


def run_export(spark) -> str:
    """Publishes the best checkpoint of the run, with the metrics of its epoch."""
    config = TrainConfig.from_env()
    checkpoints = spark.read.parquet(os.environ["CHECKPOINTS_PATH"])
    chosen = checkpoints.where((F.col("run_id") == config.run_id) & F.col("loss").isNotNull())
    best = chosen.orderBy("loss", "epoch").first()
    metrics = {"loss": best["loss"], "epoch": float(best["epoch"])} if best else {}
    data = versions.resolve_data(spark, config.tokenized_dir)
    return " ".join(export_run(spark, config, checkpoints, data, metrics))


def run_check(spark) -> str:
    """Fails if the rows of the current version are not those that were published."""
    version = versions.resolve_data(spark, TrainConfig.from_env().tokenized_dir)
    changed = check_version(spark, version).where(~F.col("intact")).collect()
    if changed:
        raise JobFailed(f"{version} was changed: {[row.asDict() for row in changed]}")
    return version


def _new_lines(spark, config: AuditConfig):
    """The log as a stream; its schema is that of the files there are."""
    schema = spark.read.parquet(config.log_path).schema
    return spark.readStream.schema(schema).parquet(config.log_path)


def run_reports(spark) -> str:
    config = AuditConfig.from_env()
    reports = ReportTable(spark, f"{config.report_path}/table")
    stream = _new_lines(spark, config).writeStream.foreachBatch(reports.apply).option(
        "checkpointLocation", f"{config.report_path}/checkpoint"
    )
    stream.trigger(availableNow=True).start().awaitTermination()
    reports.compact()
    return reports.root


def run_watch(spark) -> str:
    config = AuditConfig.from_env()
    output = f"{config.report_path}/verdicts"
    stream = watch_jobs(_new_lines(spark, config), config.job_timeout).writeStream.option(
        "checkpointLocation", f"{config.report_path}/checkpoint"
    )
    stream.format("parquet").option("path", output).trigger(availableNow=True).start(
    ).awaitTermination()
    return output


def _reported(spark, config: AuditConfig, report, failing) -> str:
    """Writes a report, then fails if too many of its rows do."""
    report.write.mode("errorifexists").parquet(config.report_path)
    bad = spark.read.parquet(config.report_path).where(failing)
    count = bad.count()
    if count > config.max_failing:
        first = json.dumps(bad.first().asDict(), ensure_ascii=False, default=str)
        raise JobFailed(f"{count} rows of {config.report_path} fail, among them {first}")
    return config.report_path


def run_audit_streams(spark) -> str:
    config = AuditConfig.from_env()
    report = audits.stream_audit(
        spark.read.parquet(config.log_path), round(config.min_stream_span * 1_000_000)
    )
    return _reported(spark, config, report, F.col("verdict") != "ok")


def run_audit_responses(spark) -> str:
    config = AuditConfig.from_env()
    report = audits.response_audit(spark.read.parquet(config.log_path))
    return _reported(spark, config, report, F.col("reason") != "ok")


def run_audit_models(spark) -> str:
    config = AuditConfig.from_env()
    report = audits.model_listed(spark.read.parquet(config.log_path), config.model_id)
    return _reported(spark, config, report, ~F.col("listed"))


def run_status(spark) -> str:
    config = AuditConfig.from_env()
    report = status.job_outcome(spark.read.parquet(config.log_path), config.job_timeout)
    return _reported(spark, config, report, F.col("outcome") != "success")


def run_capacity(spark) -> str:
    config = AuditConfig.from_env()
    accounted = capacity.capacity_accounting(
        spark.read.parquet(config.log_path), capacity.known_models(spark)
    )
    report = capacity.capacity_findings(accounted)
    return _reported(spark, config, report, F.size("findings") > 0)


JOBS = {
    "prepare": run_prepare, "batches": run_batches, "infer": run_infer, "export": run_export,
    "audit-streams": run_audit_streams, "audit-responses": run_audit_responses,
    "audit-models": run_audit_models, "status": run_status, "capacity": run_capacity,
    "check": run_check, "reports": run_reports, "watch": run_watch,
}


def main(job: str) -> None:
    spark = build_session(f"pairmill {job}")
    try:
        print(JOBS[job](spark))
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1])
