import datetime as dt
import json
import sys

import numpy as np
import pytest
from rows import collected, table
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pairmill import jobs
from pairmill.config import GenConfig, PrepConfig, TrainConfig
from pairmill.errors import JobFailed
from pairmill.operators import gate, generate
from pairmill.plans import handoff, inference
from pairmill.plans.prepare import prepare, read_manifest
from pairmill.sinks import publish as sink
from pairmill.sources import files, raw, versions

# The stand-in models below travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS = "instruction string, response string"


def config(folder, run="one", **more):
    return PrepConfig(f"{folder}/raw", f"{folder}/data", run, "base", max_len=300, **more)


def some_pairs(spark, n=40):
    rows = [(f"question {i}", f"answer {i} with a few words") for i in range(n)]
    return table(spark, rows + rows[:10] + [(" ", "x"), (None, "y")], PAIRS)


def good_model(version="", sampling=None):
    return lambda prompts: np.array([f"re: {p}" for p in prompts], dtype=object)


def silent_model(version, sampling):
    return lambda prompts: np.array([None] * len(prompts), dtype=object)


def telling_model(version, sampling):
    return lambda prompts: np.array([json.dumps([version, sampling])] * len(prompts), dtype=object)


def test_demo_run_without_any_data(spark, folder):
    version = prepare(spark, config(folder))
    manifest = read_manifest(spark, version).first().asDict()
    assert manifest == {
        "run_id": "one", "base_model": "base", "raw_rows": 128, "deduped_rows": 8,
        "train_rows_before_tokenize": 6, "train_rows": 6, "rejected_overlength": 0,
        "eval_rows": 2, "max_len": 300, "min_answer_tokens": 16,
    }
    # A second run finds the demo data instead of adding to it.
    again = prepare(spark, config(folder, "two"))
    assert read_manifest(spark, again).first()["raw_rows"] == 128
    assert versions.resolve_data(spark, f"{folder}/data") == again
    assert versions.read_train(spark, version).count() == 6


def test_published_rows(spark, folder):
    version = prepare(spark, config(folder), some_pairs(spark))
    manifest = read_manifest(spark, version).first()
    assert (manifest["raw_rows"], manifest["deduped_rows"], manifest["eval_rows"]) == (52, 40, 10)
    train, held_out = versions.read_train(spark, version), versions.read_eval(spark, version)
    assert train.columns == ["content_hash", "input_ids", "attention_mask", "labels"]
    assert {len(r["labels"]) for r in train.collect()} == {300}
    assert train.count() == 30 and held_out.columns == ["instruction", "response"]
    bare = prepare(spark, config(folder, "bare"), some_pairs(spark), lineage=False)
    assert versions.read_train(spark, bare).columns == ["input_ids", "attention_mask", "labels"]


def test_guards_of_preparation(spark, folder):
    prepare(spark, config(folder), some_pairs(spark))
    with pytest.raises(JobFailed, match="already exists"):
        prepare(spark, config(folder), some_pairs(spark))
    with pytest.raises(JobFailed, match="no training rows"):
        prepare(spark, config(folder, "single"), some_pairs(spark, 1))
    with pytest.raises(JobFailed, match="no training rows"):
        prepare(spark, config(folder, "none"), table(spark, [(" ", "a")], PAIRS))
    tight = PrepConfig("", f"{folder}/data", "tight", max_len=20)
    with pytest.raises(JobFailed, match="too long"):
        prepare(spark, tight, some_pairs(spark))
    # None of the failures moved the pointer.
    assert versions.resolve(spark, f"{folder}/data").endswith("/v-one")


def test_a_claimed_version_is_not_claimed_again(spark, folder):
    version = sink.claim_version(spark, folder, "v-1")
    with pytest.raises(JobFailed):
        sink.claim_version(spark, folder, "v-1")
    with pytest.raises(JobFailed, match="no parquet"):
        versions.resolve_data(spark, version)
    with pytest.raises(JobFailed, match="not found"):
        versions.resolve(spark, f"{folder}/nowhere")
    sink.publish(spark, version)
    sink.publish(spark, sink.claim_version(spark, folder, "v-2"))
    assert versions.resolve(spark, folder).endswith("/v-2")
    sink.publish(spark, version)
    assert versions.resolve(spark, folder).endswith("/v-1")


def write_lines(folder, lines):
    import os

    os.makedirs(folder)
    with open(f"{folder}/rows.jsonl", "w", encoding="utf-8") as file:
        file.write("\n".join(lines))


def test_raw_formats(spark, folder):
    assert not raw.has_input(spark, folder)
    rows = [
        {"instruction": "a", "response": "b", "repeat": 3},
        {"instruction": 0, "response": "b"}, {"instruction": False, "response": "b"},
        {"instruction": [], "response": {}}, {"instruction": True, "response": 5},
        {"instruction": None, "response": ""}, {"response": "é\"\\\n"},
    ]
    write_lines(folder, [json.dumps(r, ensure_ascii=False) for r in rows])
    assert raw.has_input(spark, folder) and not raw.has_input(spark, folder, "parquet")
    plain = raw.read_pairs(spark, folder).collect()
    assert [r["instruction"] for r in plain] == ["a", "0", "false", "[]", "true", None, None]
    assert plain[6]["response"] == 'é"\\\n'
    strict = raw.read_pairs(spark, folder, strict=True).collect()
    assert [tuple(r) for r in strict] == [
        ("a", "b"), (None, "b"), (None, "b"), (None, None), ("True", "5"), (None, None),
        (None, 'é"\\\n'),
    ]


def test_a_malformed_line_fails_the_job(spark, folder):
    write_lines(folder, ['{"instruction":"a","response":"b"}', '{"instruction":'])
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        raw.read_pairs(spark, folder).collect()


def test_parquet_pairs(spark, folder):
    some_pairs(spark).write.parquet(f"{folder}/raw")
    assert raw.has_input(spark, f"{folder}/raw", "parquet")
    settings = config(folder, "p", raw_format="parquet")
    assert read_manifest(spark, prepare(spark, settings)).first()["raw_rows"] == 52


def test_inference_gate_writes_its_report_before_failing(spark, folder):
    prepare(spark, config(folder), some_pairs(spark))
    files.write_text(spark, f"{folder}/model/weights", "x")

    def run(name, model, **more):
        settings = GenConfig(f"{folder}/model", f"{folder}/data", f"{folder}/out", name, **more)
        return inference.run_inference(spark, settings, model)

    output = run("good", good_model)
    report = spark.read.schema(inference.REPORT).json(f"{output}/acceptance").first()
    assert (report["rows_total"], report["rows_checked"], report["rows_unusable"]) == (10, 10, 0)
    assert report["passed"] and report["eval_version"].endswith("/v-one")
    told = inference.read_generated(spark, run("telling", telling_model, max_tokens=9)).first()
    assert json.loads(told["generated"]) == [
        f"{folder}/model", {"temperature": 0.0, "max_tokens": 9, "detokenize": False},
    ]
    sampled = run("sampled", good_model, accept_sample=4, concurrency=2)
    report = spark.read.schema(inference.REPORT).json(f"{sampled}/acceptance").first()
    assert (report["rows_total"], report["rows_checked"]) == (10, 4)
    with pytest.raises(JobFailed, match="unusable"):
        run("silent", silent_model)
    report = spark.read.schema(inference.REPORT).json(f"{folder}/out/v-silent/acceptance").first()
    assert report["rows_unusable"] == 10 and report["passed"] is False
    run("tolerated", silent_model, max_empty_fraction=1.0)
    with pytest.raises(JobFailed, match="already exists"):
        run("good", good_model)
    with pytest.raises(JobFailed, match="not found"):
        settings = GenConfig(f"{folder}/nothing", f"{folder}/data", f"{folder}/out", "x")
        inference.run_inference(spark, settings, good_model)


def test_gate_without_rows_fails_without_a_report(spark, folder):
    empty = table(spark, [], "instruction string, reference string, generated string")
    empty.write.parquet(f"{folder}/generated")
    with pytest.raises(JobFailed, match="no generated rows"):
        inference.accept(spark, GenConfig(), folder, "m", "e")
    assert not files.exists(spark, f"{folder}/acceptance")


@pytest.mark.parametrize(
    "answers,limit,bad,passed",
    [
        (["ok"] * 10, 0.0, 0, True), (["ok"] * 9 + [None], 0.0, 1, False),
        (["ok"] * 9 + ["  "], 0.1, 1, True), ([None, " ", "None"], 0.7, 2, True),
    ],
)
def test_gate(spark, answers, limit, bad, passed):
    rows = [(str(i), "r", a) for i, a in enumerate(answers)]
    frame = table(spark, rows, "instruction string, reference string, generated string")
    report = gate.acceptance_report(frame, max_empty_fraction=limit).first()
    assert (report["rows_checked"], report["rows_unusable"]) == (len(answers), bad)
    assert report["passed"] is passed
    assert gate.preview(frame).count() == 2


def test_gate_sample_with_a_third_of_equal_rows(spark):
    rows = [("same", "r", None)] * 100 + [(str(i), "r", "ok") for i in range(200)]
    frame = table(spark, rows, "instruction string, reference string, generated string")
    for n in (1, 50, 299, 300, 400):
        report = gate.acceptance_report(frame, n).first()
        assert report["rows_checked"] == min(n, 300)
    assert report["rows_unusable"] == 100


def test_generation_defaults_a_missing_reference_only(spark):
    asked = table(spark, [("q",)], "instruction string")
    assert generate.batch_generate(asked, good_model).first()["reference"] == ""
    asked = table(spark, [("q", None)], PAIRS)
    assert generate.batch_generate(asked, good_model).first()["reference"] is None


def test_a_filter_behind_generation_does_not_repeat_it(spark):
    rows = generate.batch_generate(some_pairs(spark), good_model)
    plan = rows.where(F.length("generated") > 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_request_bodies_escape(spark):
    text = 'quote " back \\ line \n tab \t é \U0001f600 </x>'
    row = generate.request_bodies(table(spark, [(text,)], "instruction string"), "m").first()
    assert json.loads(row["body"]) == {
        "model": "m", "messages": [{"role": "user", "content": text}], "max_tokens": 128,
        "temperature": 0, "stream": False,
    }
    assert "é" in row["body"]


def test_context_check():
    inference.check_context(GenConfig(), 1792)
    with pytest.raises(JobFailed):
        inference.check_context(GenConfig(), 1793)


def test_batches_and_export(spark, folder):
    version = prepare(spark, config(folder), some_pairs(spark))
    train = TrainConfig(f"{folder}/data", f"{folder}/models", "run", num_workers=4)
    assert handoff.write_batches(spark, train, f"{folder}/batches") == version
    rows = spark.read.parquet(f"{folder}/batches")
    sizes = collected(rows.groupBy("epoch", "shard").count())
    assert [s[2] for s in sizes] == [8, 7, 8, 7] * 2 or sorted(s[2] for s in sizes[:4]) == [7, 7, 8, 8]
    assert rows.select("content_hash").distinct().count() == 30

    schema = "run_id string, epoch int, loss double, checkpoint string"
    chosen = table(spark, [("run", 0, 0.5, "a"), ("run", 1, 0.7, "b"), ("x", 0, 0.1, "c")], schema)
    model, checkpoint = handoff.export_run(spark, train, chosen, version, {"loss": 0.5})
    assert checkpoint == "a" and versions.resolve(spark, f"{folder}/models") == model
    record = spark.read.schema(handoff.PROVENANCE).json(f"{model}/provenance").first()
    assert record["data_rows"] == 30 and record["checkpoint_selection"] == "best-by-loss"
    assert record["metrics"] == {"loss": 0.5} and record["data_version"] == version
    with pytest.raises(JobFailed, match="no checkpoint"):
        handoff.export_run(spark, TrainConfig(run_id="other"), chosen, version, {})


def test_epoch_without_a_valid_step_fails(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("r", 0, 0, 1.0), ("r", 0, 0, nan), ("r", 0, 0, 2.0), ("r", 0, 1, 99.0),
            ("r", 0, 0, None)]
    schema = "run_id string, epoch int, rank int, loss double"
    got = handoff.checked_epoch_loss(table(spark, rows, schema)).first()
    assert (got["loss"], got["steps"], got["skipped_batches"]) == (1.5, 2, 2)
    with pytest.raises(JobFailed, match="no finite loss"):
        handoff.checked_epoch_loss(table(spark, rows + [("r", 1, 0, nan), ("r", 1, 0, inf)], schema))


def test_jobs_from_the_environment(spark, folder, monkeypatch, capsys):
    monkeypatch.setenv("SHARED_DIR", folder)
    monkeypatch.setenv("RUN_ID", "env")
    monkeypatch.setenv("MAX_LEN", "200")
    monkeypatch.setenv("EVAL_MAX_FRACTION", "0.5")
    monkeypatch.setenv("BATCHES_DIR", f"{folder}/batches")
    monkeypatch.setenv("GENERATOR", f"{__name__}:good_model")
    monkeypatch.setenv("MAX_EMPTY_FRACTION", "1.0")
    jobs.main("prepare")
    version = f"{folder}/data/tokenized/v-env"
    assert read_manifest(spark, version).first()["eval_rows"] == 4
    jobs.main("batches")
    assert spark.read.parquet(f"{folder}/batches").count() == 8
    files.write_text(spark, f"{folder}/models/weights", "x")
    jobs.main("infer")
    assert capsys.readouterr().out.split() == [version, version, f"{folder}/outputs/batch/v-env"]


def run_job(spark, monkeypatch, job, **settings):
    for name, value in settings.items():
        monkeypatch.setenv(name, str(value))
    return jobs.JOBS[job](spark)


START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LOGS = {
    "audit-streams": (
        "request_id string, seq bigint, arrived_at timestamp, line string, transfer_rc int",
        [("a", 0, START, 'data: {"choices":[{"delta":{"content":"x"}}]}', None),
         ("a", 1, START, "data: [DONE]", None), ("a", 2, START, None, 0)],
        [("b", 0, START, "data: {", None), ("b", 1, START, None, 0)], "verdict", "unparseable",
    ),
    "audit-responses": (
        "id int, body string",
        [(1, '{"choices":[{"message":{"content":"x"},"finish_reason":"stop"}]}')],
        [(2, '{"error":1}')], "reason", "error",
    ),
    "audit-models": (
        "id int, body string", [(1, '{"data":[{"id":"m"}]}')], [(2, '{"data":[]}')], "listed", False,
    ),
    "status": (
        "job string, observed_at timestamp, seq bigint, deploy_status string, job_status string, "
        "reason string, message string",
        [("a", START, 0, "Complete", "SUCCEEDED", None, None)],
        [("b", START, 0, "Complete", "FAILED", "AppFailed", "out of memory")], "outcome", "failed",
    ),
    "capacity": (
        "model string, card_gb int, gpu_memory_utilization double, tensor_parallel_size int, "
        "max_model_len int, target_ongoing_requests int, max_ongoing_requests int",
        [("qwen3-8b", 80, 0.85, 1, 4096, 32, 64)], [("qwen3-8b", 16, 0.85, 1, 4096, 32, 64)],
        "findings", ["weights_exceed_memory"],
    ),
}


@pytest.mark.parametrize("job", LOGS)
def test_audit_jobs_report_and_then_fail(spark, folder, monkeypatch, job):
    schema, good, failing, column, found = LOGS[job]
    table(spark, good, schema).write.parquet(f"{folder}/good")
    table(spark, good + failing, schema).write.parquet(f"{folder}/all")
    monkeypatch.setenv("MODEL_ID", "m")
    out = run_job(spark, monkeypatch, job, LOG_PATH=f"{folder}/good", REPORT_PATH=f"{folder}/r1")
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(JobFailed, match="1 rows"):
        run_job(spark, monkeypatch, job, LOG_PATH=f"{folder}/all", REPORT_PATH=f"{folder}/r2")
    assert found in [r[column] for r in spark.read.parquet(f"{folder}/r2").collect()]
    run_job(
        spark, monkeypatch, job, LOG_PATH=f"{folder}/all", REPORT_PATH=f"{folder}/r3", MAX_FAILING=1
    )


def test_limits_of_the_stream_audit_are_settings(spark, folder, monkeypatch):
    def line(i, ms, text):
        frame = json.dumps({"choices": [{"delta": {"content": text}}]})
        return ("a", i, START + dt.timedelta(milliseconds=ms), f"data: {frame}", None)

    rows = [line(0, 0, "x"), line(1, 50, "y"), ("a", 2, START, "data: [DONE]", None), ("a", 3, START, None, 0)]
    table(spark, rows, LOGS["audit-streams"][0]).write.parquet(f"{folder}/log")
    with pytest.raises(JobFailed, match="buffered"):
        run_job(spark, monkeypatch, "audit-streams", LOG_PATH=f"{folder}/log", REPORT_PATH=f"{folder}/r1")
    run_job(
        spark, monkeypatch, "audit-streams", LOG_PATH=f"{folder}/log", REPORT_PATH=f"{folder}/r2",
        MIN_STREAM_SPAN=0.04,
    )


def test_export_job_publishes_the_best_checkpoint(spark, folder, monkeypatch):
    prepare(spark, config(folder), some_pairs(spark))
    rows = [("r", 0, 2.0, "c0"), ("r", 1, 1.0, "c1"), ("other", 0, 0.1, "x")]
    table(spark, rows, "run_id string, epoch int, loss double, checkpoint string").write.parquet(
        f"{folder}/checkpoints"
    )
    out = run_job(
        spark, monkeypatch, "export", CHECKPOINTS_PATH=f"{folder}/checkpoints", RUN_ID="r",
        TOKENIZED_DIR=f"{folder}/data", MODEL_ROOT=f"{folder}/models",
    )
    version, checkpoint = out.split(" ")
    assert checkpoint == "c1" and versions.resolve(spark, f"{folder}/models") == version
    record = spark.read.json(f"{version}/provenance").first()
    assert record["data_rows"] == 30 and record["metrics"]["loss"] == 1.0


def test_tokenizing_concurrency_is_a_setting(spark, folder):
    version = prepare(spark, config(folder, tokenize_partitions=3), some_pairs(spark))
    assert versions.read_train(spark, version).count() == 30


def test_run_ids_are_times_of_the_driver():
    one = PrepConfig().run_id
    assert dt.datetime.strptime(one, "%Y%m%d-%H%M%S") and PrepConfig(run_id="x").run_id == "x"
