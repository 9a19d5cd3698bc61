import pytest
from rows import table

from pairmill.operators import capacity

CONFIG = (
    "model string, card_gb int, gpu_memory_utilization double, tensor_parallel_size int, "
    "max_model_len int, target_ongoing_requests int, max_ongoing_requests int"
)
# model, card: bytes per token, token budget, worst case, findings, by length.
GOLDEN = {
    ("qwen3-8b", 24): (147456, 27252, 6.65, ["oversubscribed"], [53, 26, 13, 6]),
    ("qwen3-8b", 80): (147456, 350060, 85.46, [], [683, 341, 170, 85]),
    ("qwen2.5-7b", 24): (57344, 90136, 22.01, ["oversubscribed"], [176, 88, 44, 22]),
    ("qwen2.5-7b", 80): (57344, 920214, 224.66, [], [1797, 898, 449, 224]),
    ("qwen2.5-0.5b", 24): (12288, 1579752, 385.68, [], [3085, 1542, 771, 385]),
    ("qwen2.5-0.5b", 80): (12288, 5453450, 1331.41, ["too_conservative"], [10651, 5325, 2662, 1331]),
}


def accounted(spark, rows):
    return capacity.capacity_accounting(table(spark, rows, CONFIG), capacity.known_models(spark))


def test_golden_values(spark):
    frame = accounted(spark, [(m, c, 0.85, 1, 4096, 32, 64) for m, c in GOLDEN])
    for r in capacity.capacity_findings(frame).collect():
        per_token, budget, worst, findings, _ = GOLDEN[(r["model"], r["card_gb"])]
        assert r["kv_bytes_per_token"] == per_token and int(r["token_budget"]) == budget
        assert round(r["worst_case_sequences"], 2) == worst and r["findings"] == findings
    at = capacity.capacity_by_length(frame).orderBy("average_length").collect()
    for key, golden in GOLDEN.items():
        assert [r["sequences"] for r in at if (r["model"], r["card_gb"]) == key] == golden[4]


@pytest.mark.parametrize(
    "row,findings",
    [
        (("qwen3-8b", 16, 0.85, 1, 4096, 32, 64), ["weights_exceed_memory"]),
        (("qwen3-8b", 80, 0.85, 1, 4096, 32, 32), ["no_buffer"]),
        (("qwen3-8b", 80, 0.85, 2, 4096, 32, 64), []),
        (("qwen3-8b", 80, 0.85, 1, 4096, None, 64), []),
        (("qwen3-8b", 80, 0.85, 1, 4096, 0, 0), []),
        (("qwen3-8b", 24, 0.85, 1, 4096, 32, 16), ["oversubscribed", "no_buffer"]),
    ],
)
def test_findings(spark, row, findings):
    assert capacity.capacity_findings(accounted(spark, [row])).first()["findings"] == findings


def test_numbers_behind_a_finding(spark):
    row = ("qwen3-8b", 80, 0.85, 1, 4096, 32, 64)
    got = capacity.capacity_findings(accounted(spark, [row])).first()
    assert got["reserved_bytes"] == 68e9 and got["weight_bytes"] == 16_381_470_720
    assert got["sequence_bytes"] == 147456 * 4096 and round(got["target_ratio"], 2) == 2.67
