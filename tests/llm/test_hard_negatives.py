"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairmill.llm.hard_negatives import (
    Best, Codebooks, IndexSettings, Mining, Shard, hard_negatives,
)
from pairmill.llm.vectors import packed

SCHEMA = "vec_id long, embedding array<double>, label int, c1 int, shard string, need long"


def frame(spark, rows):
    made = [
        (i, v and [None if c is None else float(c) for c in v], label, 1, "s", 2)
        for i, v, label in rows
    ]
    return spark.createDataFrame(made, SCHEMA)


def whole(vector, length, scale):
    if vector is None or len(vector) != length:
        return None
    if any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(scale * c) for c in vector]


def expected(rows, anchor_of, mining=Mining()):
    lengths = [len(v) for _, v, _ in rows if v is not None]
    length = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    limit = min(math.isqrt((2**63 - 1) // length), 2**31 - 1)
    known = []
    for i, vector, label in rows:
        value = whole(vector, length, mining.scale)
        if i is not None and label is not None and value and max(map(abs, value)) <= limit:
            known.append((i, label, value))
    anchors = {}
    for i, label, value in known:
        if anchor_of(i):
            key = (label, np.array(value, "<i4").tobytes())
            anchors[i] = min(anchors.get(i, key), key)
    out = []
    for a, (label, raw) in anchors.items():
        value = np.frombuffer(raw, "<i4").tolist()
        scored = [
            (-sum(x * y for x, y in zip(value, other)), i, own) for i, own, other in known
        ]
        best = sorted((s, i) for s, i, own in scored if own == label and i != a)
        for s, i in best[: mining.positives]:
            window = sorted(
                (t, j) for t, j, own in scored
                if own != label and -mining.low * s <= -100 * t <= -mining.high * s
            )
            for rank, (t, j) in enumerate(window[: mining.negatives], 1):
                out.append((a, i, rank, j, -s, -t))
    return sorted(out)


def result(found):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.select(names).collect())


def clustered(seed, size=700, length=9):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, length))
    rows = []
    for i in range(size):
        # A third of the rows lies in one cell; few different components make ties.
        k = 0 if i % 3 == 0 else int(rng.integers(12))
        vector = np.round((centres[k] + 0.3 * rng.normal(size=length)) * 4) / 4
        rows.append((i, [float(c) for c in vector], int(rng.integers(3)) if k else k % 3))
    return rows


@pytest.mark.parametrize("seed, settings", [
    (1, IndexSettings()),
    (2, IndexSettings(codewords=6, shard_rows=40, block_anchors=3)),
    (3, IndexSettings(codewords=3, shard_rows=10_000, block_anchors=7)),
    (4, IndexSettings(codewords=5, shard_rows=25, sample_bytes=4000)),
])
def test_results_equal_all_scores(spark, seed, settings):
    rows = clustered(seed)
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0, settings=settings)
    assert result(found) == expected(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], i % 2) for i in range(60)]
    rows += [
        (100, None, 1), (105, [], 1), (110, [1.0, None, 0, 0], 1), (115, [math.nan, 0, 0, 0], 0),
        (120, [math.inf, 0, 0, 0], 0), (125, [1.0, 0.5], 0), (130, [1.0] * 4, None),
        (None, [1.0] * 4, 1), (135, [0.0] * 4, 1), (140, [1e30] * 4, 1), (145, [2e6] * 4, 0),
        (145, [2e6] * 4, 0), (150, [2e6, 2e6, 2e6, 1.9e6], 1), (155, [-1.0] * 4, 0),
        (5, [0.5] * 4, 1), (5, [0.5] * 4, 1), (10, rows[10][1], 0),
    ]
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert result(found) == expected(rows, lambda i: i % 5 == 0)
    assert result(hard_negatives(frame(spark, []), F.col("vec_id") % 5 == 0)) == []
    assert result(hard_negatives(frame(spark, rows), F.col("vec_id") < 0)) == []
    single = [(i, [i / 10], i % 3) for i in range(30)]
    found = hard_negatives(frame(spark, single), F.col("vec_id") % 5 == 0)
    assert result(found) == expected(single, lambda i: i % 5 == 0)


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(3)
    values = rng.integers(-300, 300, size=(400, 7)).astype(float)
    books = Codebooks(values, 7, 6)
    (c1, d1), (c2, d2) = books.codes(values)
    cells = {}
    for a, b, x, y in zip(c1, c2, d1, d2):
        n, p, q = cells.get((a, b), (0, 0, 0))
        cells[a, b] = n + 1, max(p, x), max(q, y)
    books.fill([(*k, *v) for k, v in sorted(cells.items())], 50)
    shard = Shard(pa.table({
        "vec_id": np.arange(400), "label": np.zeros(400, dtype=np.int64),
        "vector": packed(values.astype("<i4")), "c1": c1, "c2": c2,
    }))
    anchor = values[:1]
    s1, s2 = books.half_scores(anchor)
    visited = list(shard.visit(s1[0], s2[0]))
    assert len(visited) == len(cells) and sum(e - s for _, s, e in visited) == 400
    assert [v[0] for v in visited] == sorted((v[0] for v in visited), reverse=True)
    assert all(shard.scores(s, e, anchor[0]).max() <= bound for bound, s, e in visited)
    # No shard is larger than asked, and every cell has its own shards.
    load = {}
    for (n, _, _), first, parts in zip((v for _, v in sorted(cells.items())), books.first, books.parts):
        for p in range(parts):
            load[first + p] = load.get(first + p, 0) + n / parts
    assert max(load.values()) <= 50 and sorted(load) == list(range(len(load)))


def test_ties_rank_by_id():
    best = Best(2)
    best.add(np.array([5, 5, 5]), np.array([9, 3, 7]))
    best.add(np.array([5, 4]), np.array([1, 0]))
    assert best.found == [(5, 1), (5, 3)] and best.last == 5
