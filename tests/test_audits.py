import datetime as dt
import json
import random

import duckdb
import pandas as pd
import pytest
from rows import collected, table

from pairmill import session
from pairmill.catalog import queries
from pairmill.catalog.oracle import LINES as ORACLE_LINES
from pairmill.catalog.oracle import ORACLE
from pairmill.catalog.queries import QUERIES
from pairmill.functions import events as E
from pairmill.operators import audits
from pairmill.streaming.live_audit import live_stream_audit

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LINES = "request_id string, seq bigint, arrived_at timestamp, line string, transfer_rc int"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def data(content):
    return "data: " + json.dumps({"choices": [{"delta": {"content": content}}]}, ensure_ascii=False)


def choices(value):
    return "data: " + json.dumps({"choices": value})


DONE = "data: [DONE]"
OK = [(0.0, data("a")), (1.0, data("b")), (2.0, DONE)]

NOTHING = (0, 0, 0, None, None, None)
AB = (2, 2, 0, 1_000_000, None, "ab")


def bad(payload, verdict="unparseable", chunks=2):
    """What is said of OK, or its first chunk alone, with a bad payload besides."""
    text, span = "ab"[:chunks], 1_000_000 * (chunks - 1)
    return verdict, chunks, chunks, 0, span, payload, text


# Lines of one stream as (seconds, text), its transfer code or None without a close row, and the
# report: verdict, chunks, characters, protocol frames, span, evidence, preview.
STREAMS = {
    "passes": (OK, 0, ("ok", *AB)),
    "empty_object": ([(0, "{}")], 0, ("no_done", *NOTHING)),
    "frame_only": ([(0, "data: {}"), (1, DONE)], 0, ("no_content", 0, 0, 1, None, None, None)),
    "error_before_done": (
        OK[:2] + [(2, 'data: {"error": {"m": 1}}'), (3, DONE)], 0,
        bad('{"error": {"m": 1}}', "error_event"),
    ),
    "error_after_done": (
        OK + [(3, 'data: {"error": null}')], 0, bad('{"error": null}', "error_event")
    ),
    "first_fault_counts": (
        OK + [(3, 'data: {"error": 1}'), (4, "data: {")], 0, bad('{"error": 1}', "error_event")
    ),
    "failed_transfer": (OK, 28, ("transfer_failed", *AB)),
    "no_close_row": (OK, None, ("transfer_failed", *AB)),
    "one_instant": (
        [(0, data("a")), (0, data("b")), (0, DONE)], 0, ("buffered", 2, 2, 0, 0, None, "ab")
    ),
    "span_exact": (
        [(0, data("a")), (0.15, data("b")), (1, DONE)], 0, ("ok", 2, 2, 0, 150_000, None, "ab")
    ),
    "span_short": (
        [(0, data("a")), (0.149999, data("b")), (1, DONE)], 0,
        ("buffered", 2, 2, 0, 149_999, None, "ab"),
    ),
    "one_chunk": ([(0, data("a")), (0, DONE)], 0, ("ok", 1, 1, 0, 0, None, "a")),
    "no_space": ([(0, "data:" + data("a")[6:]), (1, DONE)], 0, ("no_content", *NOTHING)),
    "blank_piece": (
        [(0, data(" ")), (1, data("\n")), (2, DONE)], 0, ("ok", 2, 2, 0, 1_000_000, None, "  ")
    ),
    "empty_piece": ([(0, data("")), (1, DONE)], 0, ("no_content", 0, 0, 1, None, None, None)),
    "broken": (
        OK[:1] + [(1, 'data: {"choices":['), (2, DONE)], 0, bad('{"choices":[', chunks=1)
    ),
    "trailing": (OK[:1] + [(1, "data: {} x"), (2, DONE)], 0, bad("{} x", chunks=1)),
    "closes_the_guard": (
        OK + [(3, 'data: {"choices":[]},0]')], 0, bad('{"choices":[]},0]')
    ),
    "closes_the_guard_with_more": (
        OK + [(3, 'data: {"choices":[]}, 0 ] x')], 0, bad('{"choices":[]}, 0 ] x')
    ),
    "two_values": (OK + [(3, "data: {},{}")], 0, bad("{},{}")),
    "not_an_object": (OK + [(3, "data: [1]")], 0, bad("[1]")),
    "number": (OK + [(3, "data: 5")], 0, bad("5")),
    "long_evidence": (OK + [(3, "data: " + "x" * 300)], 0, bad("x" * 200)),
    "two_choices": (
        [(0, choices([{"delta": {"content": "x"}}, {"delta": {"content": "y"}}])), (1, DONE)], 0,
        ("buffered", 2, 2, 0, 0, None, "xy"),
    ),
    "two_choices_spread": (
        [(0, choices([{"delta": {"content": "x"}}, {"delta": {"content": ""}}])),
         (1, choices([{"delta": {}}, {"delta": {"content": "z"}}])), (2, DONE)], 0,
        ("ok", 2, 2, 0, 1_000_000, None, "xz"),
    ),
    "null_choices": (OK + [(3, choices(None))], 0, bad('{"choices": null}')),
    "object_choices": (OK + [(3, choices({"a": 1}))], 0, bad('{"choices": {"a": 1}}')),
    "empty_object_choices": (OK + [(3, choices({}))], 0, ("ok", 2, 2, 1, 1_000_000, None, "ab")),
    "empty_text_choices": (OK + [(3, choices(""))], 0, ("ok", 2, 2, 1, 1_000_000, None, "ab")),
    "text_choices": (OK + [(3, choices("{}"))], 0, bad('{"choices": "{}"}')),
    "choice_not_object": (OK + [(3, choices([1]))], 0, bad('{"choices": [1]}')),
    "null_choice": (OK + [(3, choices([None]))], 0, bad('{"choices": [null]}')),
    "falsy_delta": (
        OK + [(3, choices([{"delta": 0}])), (4, choices([{"delta": None}]))], 0,
        ("ok", 2, 2, 2, 1_000_000, None, "ab"),
    ),
    "truthy_delta": (
        OK + [(3, choices([{"delta": "x"}]))], 0, bad('{"choices": [{"delta": "x"}]}')
    ),
    "number_content": (
        [(0, choices([{"delta": {"content": 5}}])), (1, DONE)], 0,
        ("no_content", 0, 0, 1, None, None, None),
    ),
    "padded_lines": ([(t, f"  {line} \r\n") for t, line in OK], 0, ("ok", *AB)),
    "comments": ([(0, ": ping"), (0, ""), *OK], 0, ("ok", *AB)),
    "nothing": ([], 0, ("no_done", *NOTHING)),
}
WANTED = {name: report for name, (_, _, report) in STREAMS.items()}


def rows_of(name, lines, code):
    rows = [(name, i, at(t), line, None) for i, (t, line) in enumerate(lines)]
    if code is not None:
        rows.append((name, len(rows), at(9), None, code))
    return rows


def log_rows():
    return [r for name, (lines, code, _) in STREAMS.items() for r in rows_of(name, lines, code)]


def test_stream_audit(spark):
    rows = log_rows()
    random.Random(3).shuffle(rows)
    got = {r[0]: tuple(r)[1:] for r in audits.stream_audit(table(spark, rows, LINES)).collect()}
    assert got == WANTED


def by_sql(rows):
    """The registered SQL over these lines."""
    lines = pd.DataFrame(  # noqa: F841
        [(n, i, round((t - START).total_seconds() * 1e6), line, rc) for n, i, t, line, rc in rows],
        columns=["request_id", "seq", "us", "line", "transfer_rc"],
    ).astype({"request_id": "string", "line": "string", "transfer_rc": "Int32"})
    connection = duckdb.connect()
    connection.register("lines", lines)
    sql = ORACLE["stream_audit"].replace(f"{ORACLE_LINES},", "")
    return {r[0]: r[1:] for r in connection.sql(sql).fetchall()}


def random_streams(seed, count):
    draw, rows = random.Random(seed), []
    frames = [
        lambda: data(draw.choice(["a", "bc\n", "é日", "", " "]) * draw.randint(1, 30)),
        lambda: "data: {}", lambda: ": ping", lambda: DONE, lambda: "data: {", lambda: "data: {} {}",
        lambda: 'data: {"error": "x"}', lambda: choices([]), lambda: "event: x",
    ]
    weights = [60, 4, 4, 4, 1, 1, 1, 2, 2]
    for n in range(count):
        lines, t = [], 0.0
        for _ in range(2000 if n == 0 else draw.randint(0, 15)):
            lines.append((t, draw.choices(frames, weights)[0]()))
            t = round(t + draw.choice([0, 0.01, 0.1]), 6)
        rows += rows_of(f"s{n}", lines + [(t, DONE)] * draw.randint(0, 1), draw.choice([0, 0, 0, 28, None]))
    draw.shuffle(rows)
    return rows


def test_random_streams_as_the_sql_judges_them(spark):
    rows = random_streams(1, 150)
    got = {r[0]: tuple(r)[1:] for r in audits.stream_audit(table(spark, rows, LINES)).collect()}
    assert got == by_sql(rows)


def run_stream(spark, folder, batches, **options):
    for i, rows in enumerate(batches):
        path = f"{folder}/lines/batch={i}"
        table(spark, rows, LINES).coalesce(1).write.parquet(path)
    schema = LINES + ", batch int"
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/lines").drop("batch")
    )
    run = (
        live_stream_audit(stream, **options).writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    reports = spark.read.parquet(f"{folder}/out")
    found = audits.with_previews(reports, spark.read.parquet(f"{folder}/lines").drop("batch"))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


LATER = [("later", 0, START + dt.timedelta(hours=5), None, 0)]


def test_live_audit_equals_batch_audit(spark, folder):
    """Close rows come first, then lines in no order; one report per request."""
    rows = log_rows()
    cuts = [[], [], []]
    for r in rows:
        cuts[0 if r[3] is None else 1 + r[1] % 2].append(r)
    got = run_stream(spark, folder, [*cuts, LATER], lateness="10 minutes")
    assert got == WANTED


def test_a_line_behind_the_close_row_belongs_to_the_same_report(spark, folder):
    first = rows_of("g", [(0, data("aa")), (0.2, data("bb")), (0.4, DONE)], 0)
    late = [("g", 9, at(0.3), data("cc"), None)]
    got = run_stream(spark, folder, [first, late, LATER])
    assert got == {"g": ("ok", 3, 6, 0, 300_000, None, "aabbcc")}
    batch = audits.stream_audit(table(spark, first + late, LINES)).first()
    assert tuple(batch)[1:] == got["g"]


def test_a_report_waits_for_the_transfer_limit(spark, folder):
    rows = rows_of("g", OK, 0)
    soon = [("soon", 0, at(9 + 60 + 600), None, 0)]
    assert run_stream(spark, folder, [rows, soon]) == {}
    assert run_stream(spark, f"{folder}-short", [rows, soon], transfer_limit_s=30) == {"g": ("ok", *AB)}


RESPONSES = {
    '{"choices":[{"message":{"content":"hi\\nyou"},"finish_reason":"stop"}]}': ("ok", 6, "hi you"),
    '{"error":null,"choices":[{"message":{"content":"x"},"finish_reason":"stop"}]}': ("error", 1, "x"),
    '{"choices":[]}': ("no_choices", None, None),
    '{"choices":null}': ("no_choices", None, None),
    "{}": ("no_choices", None, None),
    '{"choices":[{}]}': ("no_content", None, None),
    '{"choices":[{"message":null}]}': ("no_content", None, None),
    '{"choices":[{"message":{"content":7},"finish_reason":"stop"}]}': ("no_content", None, None),
    '{"choices":[{"message":{"content":" \\u00a0"},"finish_reason":"stop"}]}': ("no_content", 2, "  "),
    '{"choices":[{"message":{"content":"x"}}]}': ("no_finish_reason", 1, "x"),
    '{"choices":[{"message":{"content":"x"},"finish_reason":""}]}': ("no_finish_reason", 1, "x"),
    "nonsense": ("unparseable", None, None),
    '{"choices":[]},0]': ("unparseable", None, None),
    '{"choices":[{"message":{"content":"x"},"finish_reason":"stop"}]},0]': ("unparseable", None, None),
    "[]": ("unparseable", None, None),
}


def test_response_audit(spark):
    frame = table(spark, list(enumerate(RESPONSES)), "id int, body string")
    got = {r["id"]: r for r in audits.response_audit(frame).collect()}
    for i, (body, (reason, chars, preview)) in enumerate(RESPONSES.items()):
        assert got[i]["reason"] == reason, body
        if preview is not None and reason != "no_content":
            assert (got[i]["content_chars"], got[i]["preview"]) == (chars, preview)
        shown = body if reason in ("unparseable", "error") else None
        assert got[i]["evidence"] == shown
        if reason == "ok":
            assert got[i]["finish_reason"] == "stop"


@pytest.mark.parametrize(
    "body,listed",
    [('{"data":[{"id":"m"},{"id":"n"}]}', True), ('{"data":[{"id":"mm"}]}', False),
     ('{"data":[{"x":1}]}', False), ('{"data":[]}', False), ("{}", False), ("x", False)],
)
def test_model_listed(spark, body, listed):
    assert audits.model_listed(table(spark, [(body,)], "body string"), "m").first()["listed"] is listed


def test_previews_read_classified_lines(spark, folder):
    """The condition on the kind of a line does not parse the log again."""
    table(spark, [("a", 0, None, "data: [DONE]", None)], LINES).write.parquet(folder)
    lines = spark.read.parquet(folder)
    events = audits.narrow_events(E.classify_lines(lines))
    found = audits.with_previews(lines.select("request_id").distinct(), lines)
    plans = [str(f._jdf.queryExecution().optimizedPlan()).lower() for f in (events, found)]
    assert ["parse_json" in plan or "parsejson" in plan for plan in plans] == [True, False]
    assert found.collect() == [("a", None)]


def conversations(spark, folder, numbers):
    text = "some words of a text that is longer than one piece of a stream, " * 3
    rows = [(n, turn, "assistant", text + str(n)) for n in numbers for turn in range(2)]
    table(spark, rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        f"{folder}/conversations.parquet")


def test_live_report_of_a_log_longer_than_a_month(spark, folder):
    """Also right before the lateness followed the log: Spark drops by the watermark of the batch before."""
    conversations(spark, folder, [1, 7, 8, 70_000, 100_001])
    live = QUERIES["live_stream_report"](spark, folder)
    batch = QUERIES["stream_audit"](spark, folder)
    assert collected(live.select(*batch.columns).fillna("")) == collected(batch.fillna(""))
    assert live.count() == 10


def test_logs_are_written_in_files_by_their_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "STREAM_ROWS", 10)
    assert queries._spread(spark.range(200), f"{folder}/log", 200, triggers=2, least=2) == 10
    assert len(spark.read.parquet(f"{folder}/log").inputFiles()) == 20
    conversations(spark, folder, [1, 2, 7])
    for name in ("live_stream_report", "live_report_table"):
        assert QUERIES[name](spark, folder).count() == 6
