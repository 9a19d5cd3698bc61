"""The physical plans the operators are meant to have."""

from rows import table

from pairmill.functions.events import classify_lines
from pairmill.functions.tokens import CodepointTokenizer
from pairmill.operators import audits, curate, encode, gate, training

PAIRS = [(f"q{i}", f"a{i}") for i in range(50)]
LINES = "request_id string, seq bigint, arrived_at timestamp, line string, transfer_rc int"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def staged(spark, folder):
    pairs = table(spark, PAIRS, "instruction string, response string")
    curate.exact_dedup(curate.with_content_hash(pairs)).write.parquet(folder)
    return spark.read.parquet(folder)


def test_holdout_over_a_written_table_is_a_pushed_comparison(spark, folder):
    train, held_out = curate.split_holdout(staged(spark, folder), total=50)
    for side, comparison in ((train, "GreaterThan"), (held_out, "LessThanOrEqual")):
        text = plan(side)
        assert "TakeOrderedAndProject" in text and "Join" not in text
        pushed = text.split("PushedFilters")[1:]
        assert any(f"{comparison}(content_hash" in p.split("ReadSchema")[0] for p in pushed)


def test_holdout_keys_read_the_hash_alone(spark, folder):
    text = plan(curate.holdout_keys(staged(spark, folder), total=50))
    assert "ReadSchema: struct<content_hash:string>" in text


def test_encoding_a_written_table_neither_shuffles_nor_leaves_the_jvm(spark, folder):
    text = plan(encode.encode_sft(staged(spark, folder), CodepointTokenizer(), 64))
    assert "Exchange" not in text and "Python" not in text


def test_dedup_combines_before_its_one_shuffle(spark):
    pairs = table(spark, PAIRS, "instruction string, response string")
    text = plan(curate.exact_dedup(curate.with_content_hash(pairs)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min" in text


def test_stream_totals_are_hashed_and_combined(spark):
    events = audits.narrow_events(classify_lines(table(spark, [], LINES)))
    text = plan(audits.stream_totals(events))
    assert "partial_sum" in text and text.count("Exchange") <= 2
    assert text.count("parseJson") <= 3


def test_the_log_is_parsed_once_for_report_and_preview(spark):
    text = plan(audits.stream_audit(table(spark, [], LINES)))
    # What is left reads the written events.
    assert "parseJson" not in text and text.count("WindowGroupLimit") == 2


def test_a_sample_does_not_shuffle_all_keys(spark):
    rows = table(spark, [("q", "a", "a")], "instruction string, reference string, generated string")
    text = plan(gate.accept_sample(rows, 5))
    assert "TakeOrderedAndProject" in text and "hashpartitioning" not in text


def test_batch_plan_has_no_global_sort(spark, folder):
    text = plan(training.batch_plan(staged(spark, folder)))
    assert "SinglePartition" not in text and "rangepartitioning" not in text


def test_checkpoint_topk_limits_before_its_shuffle(spark):
    rows = table(spark, [], "run_id string, epoch int, loss double, checkpoint string")
    assert plan(training.checkpoint_topk(rows)).count("WindowGroupLimit") == 2
