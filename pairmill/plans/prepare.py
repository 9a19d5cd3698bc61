"""Raw pairs to a published data version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.config import ChatTemplate, PrepConfig
from pairmill.errors import JobFailed
from pairmill.functions.tokens import CodepointTokenizer
from pairmill.operators.curate import (
    holdout_size, keyed_pairs, split_holdout, with_content_hash,
)
from pairmill.operators.encode import encode_sft
from pairmill.operators.fingerprint import FINGERPRINTS, covers, side_fingerprints
from pairmill.operators.late_dedup import fetch, first_places, place_rows
from pairmill.session import scratch_path, sized_shuffles
from pairmill.sinks import publish as sink
from pairmill.sources import files, raw, versions

MANIFEST = (
    "run_id string, base_model string, raw_rows bigint, deduped_rows bigint, "
    "train_rows_before_tokenize bigint, train_rows bigint, rejected_overlength bigint, "
    "eval_rows bigint, max_len bigint, min_answer_tokens bigint"
)


def prepare(
    spark: SparkSession,
    config: PrepConfig,
    pairs: DataFrame | None = None,
    tokenizer=None,
    template: ChatTemplate = ChatTemplate(),
    lineage: bool = True,
) -> str:
    """Runs the whole preparation and returns the published version's path.

    The raw data is read once and no text is shuffled: pairs are written to shared scratch as they
    come, duplicates are found from their hashes and places, and the survivors are fetched by place
    and written there too. Every later step reads only the columns and rows it needs from
    those. That also keeps the split stable if an executor is lost. Without ``pairs`` the raw folder of
    the settings is read, seeded with demo pairs when it has none. ``lineage`` keeps each row's
    content hash beside its arrays.
    """
    if files.exists(spark, f"{config.tokenized_root}/v-{config.run_id}"):
        raise JobFailed(f"version v-{config.run_id} already exists; choose another run id")
    if pairs is None:
        if not raw.has_input(spark, config.raw_dir, config.raw_format):
            raw.seed_demo_data(spark, config.raw_dir, config.raw_format)
        pairs = raw.read_pairs(spark, config.raw_dir, config.raw_format)

    staged = scratch_path(spark, f"prepare-{config.run_id}")
    placed = place_rows(keyed_pairs(pairs), f"raw-{config.run_id}")
    try:
        # Sized by the written table, whose size is known whatever the input was.
        with sized_shuffles(placed.rows):
            fetch(placed, first_places(placed, "content_hash")).write.parquet(staged)
        raw_rows = placed.rows.count()
    finally:
        files.remove(spark, placed.path)
    try:
        return _publish(
            spark, config, staged, raw_rows, tokenizer or CodepointTokenizer(), template, lineage
        )
    finally:
        files.remove(spark, staged)


def _publish(spark, config, staged, raw_rows, tokenizer, template, lineage) -> str:
    deduped = spark.read.parquet(staged)
    total = deduped.count()
    eval_rows = min(total, holdout_size(total, config.eval_rows, config.eval_max_fraction))
    before = total - eval_rows
    if before == 0:
        raise JobFailed(f"no training rows: the holdout takes all {total} pairs")

    train, held_out = split_holdout(deduped, config.eval_rows, config.eval_max_fraction, total)
    version = sink.claim_version(spark, config.tokenized_root, f"v-{config.run_id}")
    if config.tokenize_partitions:
        train = train.repartition(config.tokenize_partitions)
    encoded = encode_sft(
        train, tokenizer, config.max_len, config.min_answer_tokens, template,
        keep=("content_hash",) if lineage else (),
    )
    sink.write_train(encoded, version)
    kept = versions.read_train(spark, version).count()
    if kept == 0:
        raise JobFailed(f"every prompt is too long for max_len {config.max_len}")

    # Holdout, manifest and pointer follow only once the training rows are complete.
    sink.write_eval(held_out, version)
    sides = {
        "deduped": deduped,
        "train": train,
        "eval": with_content_hash(versions.read_eval(spark, version)),
    }
    if lineage:
        sides["kept"] = versions.read_train(spark, version)
    prints = [r.asDict() for r in side_fingerprints(sides).collect()]
    found = {p["side"]: (p["rows"], p["sum_one"], p["sum_two"]) for p in prints}
    if not covers(found, "deduped", ("train", "eval")):
        raise JobFailed(f"training rows and holdout are not the deduplicated pairs: {found}")
    manifest = {
        "run_id": config.run_id,
        "base_model": config.base_model,
        "raw_rows": raw_rows,
        "deduped_rows": total,
        "train_rows_before_tokenize": before,
        "train_rows": kept,
        "rejected_overlength": before - kept,
        "eval_rows": versions.read_eval(spark, version).count(),
        "max_len": config.max_len,
        "min_answer_tokens": config.min_answer_tokens,
        "fingerprints": prints,
    }
    schema = f"{MANIFEST}, fingerprints {FINGERPRINTS}"
    sink.write_record(spark, manifest, schema, f"{version}/manifest")
    sink.publish(spark, version)
    return version


def read_manifest(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{version}/manifest")


def read_fingerprints(spark: SparkSession, version: str) -> DataFrame:
    """(side, rows, sum_one, sum_two) as the manifest tells them."""
    record = spark.read.schema(f"fingerprints {FINGERPRINTS}").json(f"{version}/manifest")
    return record.select(F.inline("fingerprints"))


def check_version(spark: SparkSession, version: str) -> DataFrame:
    """(side, rows, rows_found, intact) of the holdout and training rows as they lie there now.

    Training rows are only known to the manifest if they carry their hashes.
    """
    told = read_fingerprints(spark, version).where(F.col("side").isin("eval", "kept"))
    train = versions.read_train(spark, version)
    sides = {"eval": with_content_hash(versions.read_eval(spark, version))}
    if "content_hash" in train.columns:
        sides["kept"] = train
    now = side_fingerprints(sides)
    same = [F.col(f"told.{c}").eqNullSafe(F.col(f"now.{c}")) for c in ("rows", "sum_one", "sum_two")]
    return told.alias("told").join(now.alias("now"), "side", "full").select(
        "side", F.coalesce("told.rows", F.lit(0)).alias("rows"),
        F.coalesce("now.rows", F.lit(0)).alias("rows_found"),
        (same[0] & same[1] & same[2]).alias("intact"),
    )
