"""The registered queries: one function of (spark, sf_dir) per operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pairmill.catalog import derive
from pairmill.config import GenConfig, PrepConfig, TrainConfig
from pairmill.functions import text
from pairmill.functions.tokens import CodepointTokenizer
from pairmill.operators import (
    audits, capacity, curate, encode, fingerprint, gate, generate, lengths, status, training,
)
from pairmill.operators.byte_pairs import BytePairs, token_ids
from pairmill.operators.late_dedup import late_dedup
from pairmill.plans import handoff, inference
from pairmill.plans.handoff import write_batches
from pairmill.plans.prepare import check_version, prepare, read_manifest
from pairmill.session import scratch_path, stream_parts, stream_settings
from pairmill.sinks import publish
from pairmill.sinks.publish import write_eval
from pairmill.sources import batches, files, raw, versions
from pairmill.streaming.job_watch import FORGET_SECONDS, latest_verdicts, watch_jobs
from pairmill.streaming.live_audit import live_stream_audit
from pairmill.streaming.report_table import ReportTable

TOKENIZER = CodepointTokenizer()
MAX_LEN = 256
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def joined(*arrays: str) -> list:
    return [F.array_join(a, ",").alias(a) for a in arrays]


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated pairs, written once, as preparation does, for the steps that read them twice."""
    rows = curate.drop_blank(derive.pairs(spark, sf_dir)).select("instruction", "response")
    staged = scratch_path(spark, "pairs")
    curate.exact_dedup(curate.with_content_hash(rows)).write.parquet(staged)
    return spark.read.parquet(staged)


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.split_holdout(deduped(spark, sf_dir))[0]


def encoded(spark: SparkSession, sf_dir: str, max_len: int = MAX_LEN) -> DataFrame:
    return encode.encode_sft(
        train_rows(spark, sf_dir), TOKENIZER, max_len, keep=("content_hash",)
    )


# Sources, sinks and versions.


@query
def sft_pairs(spark, sf_dir):
    return derive.pairs(spark, sf_dir)


@query
def sft_pairs_with_gaps(spark, sf_dir):
    return derive.thinned_pairs(spark, sf_dir)


@query
def raw_jsonl_scan(spark, sf_dir):
    path = scratch_path(spark, "raw")
    derive.repeated_pairs(spark, sf_dir).select("instruction", "response", "repeat").write.json(path)
    return raw.read_pairs(spark, path, extra=StructType([StructField("repeat", IntegerType())]))


@query
def raw_strict_scan(spark, sf_dir):
    """Pairs whose instruction is at times a number or false, told apart by their JSON type."""
    pairs = derive.pairs(spark, sf_dir)
    kind, response = F.col("conv_id") % 4, F.col("response")
    lines = (
        F.when(kind == 1, F.to_json(F.struct(F.col("turn").alias("instruction"), response)))
        .when(kind == 2, F.to_json(F.struct(F.lit(False).alias("instruction"), response)))
        .otherwise(F.to_json(F.struct("instruction", response)))
    )
    path = scratch_path(spark, "raw")
    pairs.select(lines.alias("value")).write.text(path)
    return raw.read_pairs(spark, path, strict=True)


@query
def eval_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "holdout")
    write_eval(curate.split_holdout(deduped(spark, sf_dir))[1], path)
    return versions.read_eval(spark, path)


def _published(spark, sf_dir) -> str:
    root = scratch_path(spark, "data")
    raw_dir = f"{root}/raw"
    derive.repeated_pairs(spark, sf_dir).select("instruction", "response", "repeat").write.json(
        raw_dir
    )
    config = PrepConfig(raw_dir, f"{root}/tokenized", "first", "codepoints", MAX_LEN)
    prepare(spark, config)
    return config.tokenized_root


@query
def prep_manifest(spark, sf_dir):
    version = versions.resolve_data(spark, _published(spark, sf_dir))
    return read_manifest(spark, version)


@query
def version_roundtrip(spark, sf_dir):
    version = versions.resolve_data(spark, _published(spark, sf_dir))
    return versions.read_train(spark, version).select(
        "content_hash", *joined("input_ids", "attention_mask", "labels")
    )


# Curation.


@query
def nonblank_filter(spark, sf_dir):
    return curate.drop_blank(derive.gappy_pairs(spark, sf_dir))


@query
def content_hash(spark, sf_dir):
    return curate.with_content_hash(derive.pairs(spark, sf_dir)).select(
        "conv_id", "turn", "content_hash"
    )


@query
def exact_dedup(spark, sf_dir):
    documents = derive.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("instruction"), F.col("text").alias("response"), "source"
    )
    return curate.exact_dedup(
        curate.with_content_hash(documents), tie_break=["doc_id"], copies="copies"
    )


@query
def exact_dedup_late(spark, sf_dir):
    """Each document three times, and the survivors fetched by their places."""
    documents = derive.repeated_documents(spark, sf_dir)
    return late_dedup(
        curate.with_content_hash(documents), tie_break=["doc_id", "repeat"], copies="copies"
    )


@query
def holdout_keys(spark, sf_dir):
    return curate.holdout_keys(deduped(spark, sf_dir))


@query
def holdout_eval(spark, sf_dir):
    return curate.split_holdout(deduped(spark, sf_dir))[1]


@query
def holdout_train(spark, sf_dir):
    return train_rows(spark, sf_dir)


@query
def split_invariants(spark, sf_dir):
    rows = deduped(spark, sf_dir)
    return curate.split_invariants(rows, *curate.split_holdout(rows))


@query
def split_fingerprints(spark, sf_dir):
    rows = deduped(spark, sf_dir)
    train, held_out = curate.split_holdout(rows)
    return fingerprint.side_fingerprints({"deduped": rows, "train": train, "eval": held_out})


@query
def version_check(spark, sf_dir):
    """A published version against the fingerprints in its manifest."""
    version = versions.resolve_data(spark, _published(spark, sf_dir))
    return check_version(spark, version)


# Encoding.


@query
def render_prompt(spark, sf_dir):
    return derive.pairs(spark, sf_dir).select(
        "conv_id", "turn", text.render_prompt(F.col("instruction")).alias("prompt")
    )


@query
def tokenize_codepoints(spark, sf_dir):
    return derive.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(text.codepoints(F.col("text")), ",").alias("ids")
    )


@query
def tokenize_byte_pairs(spark, sf_dir):
    """Ids of a published byte-level vocabulary, by joins."""
    turns = derive.table(spark, sf_dir, "conversations")
    vocabulary = BytePairs.read(spark, derive.vocabulary_file())
    found = token_ids(turns, "text", ["conv_id", "turn"], vocabulary)
    return found.select("conv_id", "turn", F.array_join("ids", ",").alias("ids"))


@query
def overlength_split(spark, sf_dir):
    tokens = encode.tokenize_pairs(
        derive.pairs(spark, sf_dir), TOKENIZER, keep=("conv_id", "turn")
    )
    return encode.overlength_split(tokens, MAX_LEN, 16)


@query
def encode_sft(spark, sf_dir):
    return encoded(spark, sf_dir).select(
        "content_hash", *joined("input_ids", "attention_mask", "labels")
    )


@query
def encode_sft_512(spark, sf_dir):
    return encoded(spark, sf_dir, 512).select(
        "content_hash", *joined("input_ids", "attention_mask", "labels")
    )


@query
def supervision_audit(spark, sf_dir):
    return training.supervision_audit(encoded(spark, sf_dir))


# Generation and its gate.


@query
def generation_requests(spark, sf_dir):
    requests = generate.generation_requests(derive.pairs(spark, sf_dir))
    message = F.element_at("messages", 1)
    return requests.select(
        "conv_id", "turn",
        F.size("messages").cast("bigint").alias("messages"),
        message["role"].alias("role"),
        message["content"].alias("content"),
        "sampling_params.temperature", "sampling_params.max_tokens", "sampling_params.detokenize",
    )


@query
def request_bodies(spark, sf_dir):
    bodies = generate.request_bodies(derive.pairs(spark, sf_dir), "sft-qwen")
    return bodies.select("conv_id", "turn", "body")


@query
def acceptance_report(spark, sf_dir):
    return gate.acceptance_report(derive.generated(spark, sf_dir), max_empty_fraction=0.1)


@query
def acceptance_by_turn(spark, sf_dir):
    return gate.acceptance_report(
        derive.generated(spark, sf_dir), max_empty_fraction=0.2, by=("turn",)
    )


@query
def acceptance_sample(spark, sf_dir):
    return gate.acceptance_report(derive.generated(spark, sf_dir), 50, 0.2)


@query
def acceptance_sample_by_turn(spark, sf_dir):
    return gate.acceptance_report(derive.generated(spark, sf_dir), 20, 0.2, by=("turn",))


@query
def gate_roundtrip(spark, sf_dir):
    """Generated rows written as a version and judged as read back, with the report on file."""
    root = scratch_path(spark, "outputs")
    config = GenConfig(
        f"{root}/models", f"{root}/data", f"{root}/out", "first", max_empty_fraction=0.5
    )
    output = publish.claim_version(spark, config.output_root, "v-first")
    inference.write_generated(derive.generated(spark, sf_dir), output)
    inference.accept(spark, config, output, "model", "holdout")
    return inference.read_report(spark, output)


@query
def context_budget(spark, sf_dir):
    asked = derive.table(spark, sf_dir, "documents").select(
        "source", F.length(text.render_prompt(F.col("text"))).cast("bigint").alias("prompt_tokens")
    )
    return generate.context_budget(asked, 256, 2048, by=("source",))


# Training tables.


@query
def batch_plan(spark, sf_dir):
    return training.batch_plan(deduped(spark, sf_dir).select("content_hash"), num_workers=3)


@query
def batch_steps(spark, sf_dir):
    plan = training.batch_plan(deduped(spark, sf_dir).select("content_hash"), num_workers=3)
    return training.steps_per_shard(plan)


@query
def batch_layout(spark, sf_dir):
    """The batch files as a worker finds them, with the supervised tokens of each batch."""
    root = _published(spark, sf_dir)
    output = scratch_path(spark, "batches")
    write_batches(spark, TrainConfig(root, run_id="first"), output)
    return training.supervision_audit(spark.read.parquet(output), by=("epoch", "shard", "batch"))


@query
def batch_resume(spark, sf_dir):
    """What each worker has still to read when it goes on in the middle of each epoch."""
    root = _published(spark, sf_dir)
    output = scratch_path(spark, "batches")
    config = TrainConfig(root, run_id="first")
    write_batches(spark, config, output)
    steps = batches.read_index(spark, output).groupBy("epoch", "shard").agg(
        (F.max("batch") + 1).alias("steps")
    )
    # One row per epoch and worker.
    parts = [
        batches.resume(spark, output, r["epoch"], r["shard"], r["steps"] // 2)
        .select("epoch", "shard", "batch", "pos", "content_hash")
        for r in steps.collect()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def batch_index(spark, sf_dir):
    """Rows and files of each batch as the index has them."""
    root = _published(spark, sf_dir)
    output = scratch_path(spark, "batches")
    write_batches(spark, TrainConfig(root, run_id="first"), output)
    return batches.read_index(spark, output).groupBy("epoch", "shard", "batch").agg(
        F.sum("rows").alias("rows"), F.min("first_pos").alias("first_pos")
    )


@query
def epoch_loss(spark, sf_dir):
    losses = training.epoch_loss(derive.step_losses(spark, sf_dir))
    # Sums of doubles differ in their last digits with the order of the rows.
    return losses.withColumn("loss", F.round("loss", 9))


def checkpoints(spark, sf_dir):
    losses = epoch_loss(spark, sf_dir)
    name = F.concat_ws("-", F.lit("ckpt"), F.col("run_id"), F.col("epoch"))
    # Every seventh run reports no loss, so the latest checkpoint has to stand in.
    loss = F.when(F.col("run_id") % 7 != 0, F.col("loss"))
    return losses.select("run_id", "epoch", loss.alias("loss"), name.alias("checkpoint"))


@query
def checkpoint_topk(spark, sf_dir):
    return training.checkpoint_topk(checkpoints(spark, sf_dir)).select(
        "run_id", "epoch", "checkpoint", "place"
    )


@query
def checkpoint_select(spark, sf_dir):
    return training.checkpoint_select(checkpoints(spark, sf_dir)).drop("loss")


@query
def export_provenance(spark, sf_dir):
    """The run with the lowest loss published as a model version, read back from its record."""
    root = _published(spark, sf_dir)
    data = versions.resolve_data(spark, root)
    best = checkpoints(spark, sf_dir).where("loss IS NOT NULL").orderBy("loss", "run_id").first()
    config = TrainConfig(root, f"{root}/models", run_id=str(best["run_id"]))
    version, _ = handoff.export_run(
        spark, config, checkpoints(spark, sf_dir), data, {"loss": best["loss"]}
    )
    record = handoff.read_provenance(spark, version)
    return record.select(
        "run_id", "data_rows", "checkpoint_selection", F.col("metrics")["loss"].alias("loss")
    )


# Audits.


@query
def response_audit(spark, sf_dir):
    return audits.response_audit(derive.completions(spark, sf_dir))


@query
def model_listed(spark, sf_dir):
    return audits.model_listed(derive.model_lists(spark, sf_dir), "m-3")


@query
def stream_audit(spark, sf_dir):
    return audits.stream_audit(derive.stream_lines(spark, sf_dir))


def _spread(lines, path, rows, triggers, least=1):
    """Writes a log in no order; returns how many of its files, of bounded size, make one trigger."""
    each = stream_parts(rows // triggers, least)
    lines.repartition(each * triggers).write.parquet(path)
    return each


@query
def live_stream_report(spark, sf_dir):
    """The same lines as a file stream over several triggers, in no order.

    So a line may come as late as the log is long. A line a month later than that, of a request that
    stays open, lets the watermark pass all others. Texts are looked up in the log afterwards.
    """
    root = scratch_path(spark, "stream")
    lines = derive.stream_lines(spark, sf_dir)
    arrived = F.unix_micros("arrived_at")
    seen = lines.agg(
        F.count("*").alias("rows"), (F.max(arrived) - F.min(arrived)).alias("span")
    ).first()
    days = max(30, (seen["span"] or 0) // 86_400_000_000 + 1)
    each = _spread(lines, f"{root}/lines", seen["rows"], triggers=2, least=2)
    log = spark.read.parquet(f"{root}/lines")
    latest = log.agg(F.max("arrived_at").alias("arrived_at"))
    late = latest.select(
        F.lit("").alias("request_id"), F.lit(0).cast("bigint").alias("seq"),
        F.expr(f"arrived_at + INTERVAL {days + 30} DAYS").alias("arrived_at"),
        F.lit(None).cast("string").alias("line"), F.lit(None).cast("int").alias("transfer_rc"),
    )
    late.coalesce(1).write.mode("append").parquet(f"{root}/lines")
    stream = (
        spark.readStream.schema(log.schema).option("maxFilesPerTrigger", each)
        .parquet(f"{root}/lines")
    )
    with stream_settings(spark, seen["rows"]):
        run = (
            live_stream_audit(stream, lateness=f"{days} days").writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/reports")
            .trigger(availableNow=True).start()
        )
    run.awaitTermination()
    reports = spark.read.parquet(f"{root}/reports")
    return audits.with_previews(reports, log)


@query
def live_report_table(spark, sf_dir):
    """Requests that pause for ten minutes, spread over batches, one of which runs three times.

    The first time it ends before it is in the log, as after a lost driver.
    """
    root = scratch_path(spark, "reports")
    lines = derive.paused_lines(spark, sf_dir)
    each = _spread(lines, f"{root}/lines", lines.count(), triggers=4)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", each)
    reports = ReportTable(spark, f"{root}/table")

    def broken(batch, batch_id):
        reports.apply(batch, batch_id)
        if batch_id == 1:
            files.remove(spark, f"{reports.root}/log/{batch_id}")
            reports.apply(batch, batch_id)
            reports.apply(batch, batch_id)
            reports.compact()

    run = (
        stream.parquet(f"{root}/lines").writeStream.foreachBatch(broken)
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return reports.reports()


@query
def status_changes(spark, sf_dir):
    return status.status_changes(derive.observations(spark, sf_dir))


@query
def job_outcome(spark, sf_dir):
    return status.job_outcome(derive.observations(spark, sf_dir), 43_200)


@query
def live_job_watch(spark, sf_dir):
    """The same polls as a stream, a third of the time at once, judged as they come.

    A poll of another job long after lets the clock pass all deadlines.
    """
    root = scratch_path(spark, "watch")
    polls = derive.observations(spark, sf_dir).withColumn("job", F.col("job").cast("string"))
    micros = F.unix_micros(F.col("observed_at").cast("timestamp"))
    log = polls.agg(
        F.min(micros).alias("first"), F.max(micros).alias("last"), F.count("*").alias("rows")
    ).first()
    first, span = log["first"] or 0, (log["last"] or 0) - (log["first"] or 0) + 1
    third = F.expr(f"int((unix_micros(cast(observed_at AS timestamp)) - {first}) * 3 div {span})")
    parts = [polls.where(third == k) for k in range(3)]
    later = F.expr("observed_at + INTERVAL 60 DAYS")
    parts.append(
        polls.orderBy(F.desc("observed_at")).limit(1)
        .withColumns({"job": F.lit(""), "observed_at": later})
    )
    # Started once per part, so that a part is one batch however many files it takes.
    for part, rows in zip(parts, [log["rows"] // 3] * 3 + [1]):
        part.repartition(stream_parts(rows)).write.mode("append").parquet(f"{root}/polls")
        stream = spark.readStream.schema(polls.schema).parquet(f"{root}/polls")
        found = watch_jobs(stream, 43_200, "1 hour", max(FORGET_SECONDS, span // 1_000_000))
        with stream_settings(spark, log["rows"]):
            run = (
                found.writeStream.format("parquet")
                .option("checkpointLocation", f"{root}/checkpoint")
                .option("path", f"{root}/verdicts").trigger(availableNow=True).start()
            )
        run.awaitTermination()
    verdicts = spark.read.schema(found.schema).parquet(f"{root}/verdicts")
    last = latest_verdicts(verdicts).where(~F.col("job").eqNullSafe(""))
    return last.drop("decided_at").withColumn("first_at", F.col("first_at").cast("timestamp_ntz"))


# Capacity.


def accounted(spark, sf_dir):
    documents = derive.table(spark, sf_dir, "documents")
    configs = derive.engine_configs(documents, [m[0] for m in capacity.MODELS])
    return capacity.capacity_accounting(configs, capacity.known_models(spark))


@query
def capacity_accounting(spark, sf_dir):
    return accounted(spark, sf_dir).select(
        "source", "model", "card_gb", "max_model_len", "kv_bytes_per_token",
        F.floor("token_budget").alias("token_budget"),
        F.round("worst_case_sequences", 6).alias("worst_case_sequences"),
        F.floor("reserved_bytes").alias("reserved_bytes"), "weight_bytes", "sequence_bytes",
    )


@query
def capacity_by_length(spark, sf_dir):
    return capacity.capacity_by_length(accounted(spark, sf_dir)).select(
        "source", "model", "card_gb", F.col("average_length").alias("length"), "sequences"
    )


@query
def capacity_at_observed_length(spark, sf_dir):
    return accounted(spark, sf_dir).select(
        "source", "model", "card_gb",
        F.floor(F.col("token_budget") / F.col("average_length")).alias("sequences"),
    )


@query
def capacity_at_quantiles(spark, sf_dir):
    tokens = derive.table(spark, sf_dir, "documents").select(
        "source", F.length("text").alias("tokens")
    )
    return lengths.capacity_at_quantiles(accounted(spark, sf_dir), tokens, ("source",)).select(
        "source", "model", "card_gb", "percent", "length", "sequences"
    )


@query
def length_quantiles(spark, sf_dir):
    """Read off the sketch of two halves of the documents, by language."""
    documents = derive.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.length("text").alias("tokens")
    )
    halves = [
        lengths.length_sketch(documents.where(F.col("doc_id") % 2 == half), ("lang",))
        for half in (0, 1)
    ]
    whole = lengths.merged_sketches(halves[0].unionByName(halves[1]), ("lang",))
    return lengths.sketch_quantiles(whole, ("lang",))


@query
def capacity_findings(spark, sf_dir):
    return capacity.capacity_findings(accounted(spark, sf_dir)).select(
        "source", "model", "card_gb", F.array_join("findings", ",").alias("findings"),
        F.round("target_ratio", 6).alias("target_ratio"),
    )
