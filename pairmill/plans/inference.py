"""Holdout to gated generations."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pairmill.config import ChatTemplate, GenConfig
from pairmill.errors import JobFailed
from pairmill.operators.gate import acceptance_report
from pairmill.operators.generate import SAMPLING, batch_generate
from pairmill.sinks import publish as sink
from pairmill.sources import versions

REPORT = (
    "run_id string, model_version string, eval_version string, rows_total bigint, "
    "rows_checked bigint, rows_unusable bigint, empty_fraction double, "
    "max_empty_fraction double, passed boolean"
)


def check_context(config: GenConfig, max_len: int) -> None:
    """The longest prompt preparation lets through must fit the context with its output."""
    if max_len + config.max_tokens > config.max_model_len:
        raise JobFailed(
            f"max_len {max_len} + max_tokens {config.max_tokens} exceeds max_model_len "
            f"{config.max_model_len}"
        )


def run_inference(
    spark: SparkSession,
    config: GenConfig,
    load_model: Callable,
    template: ChatTemplate = ChatTemplate(),
    preprocess=None,
) -> str:
    """Generates over the holdout, writes the rows, then judges what was written.

    Both inputs are resolved to immutable versions first. ``load_model(version, sampling)`` runs
    once per Python worker and returns the function that answers a batch of prompts.
    """
    model, holdout = versions.resolve_generation_inputs(
        spark, config.model_path, config.eval_path
    )
    sampling = {**SAMPLING, "max_tokens": config.max_tokens}
    make_predict = partial(load_model, model, sampling)
    generated = batch_generate(
        versions.read_eval(spark, holdout), make_predict, config.batch_size, config.concurrency,
        config.max_tokens, template, preprocess,
    )
    output = sink.claim_version(spark, config.output_root, f"v-{config.run_id}")
    write_generated(generated, output)
    accept(spark, config, output, model, holdout)
    return output


def write_generated(rows: DataFrame, output: str) -> None:
    rows.select("instruction", "reference", "generated").write.mode("errorifexists").parquet(
        f"{output}/generated"
    )


def read_report(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(REPORT).json(f"{output}/acceptance")


def read_generated(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/generated")


def accept(
    spark: SparkSession, config: GenConfig, output: str, model: str, holdout: str
) -> dict:
    """Judges written generations; the report is written before a failure is raised."""
    written = read_generated(spark, output)
    total = written.count()
    counted = acceptance_report(written, config.accept_sample, config.max_empty_fraction).first()
    if total == 0 or counted["rows_checked"] == 0:
        raise JobFailed("acceptance failed: no generated rows")
    report = {
        "run_id": config.run_id,
        "model_version": model,
        "eval_version": holdout,
        "rows_total": total,
        **counted.asDict(),
    }
    sink.write_record(spark, report, REPORT, f"{output}/acceptance")
    if not report["passed"]:
        raise JobFailed(
            f"acceptance failed: {report['empty_fraction']:.1%} of the outputs are unusable, "
            f"limit {config.max_empty_fraction:.1%}"
        )
    return report
