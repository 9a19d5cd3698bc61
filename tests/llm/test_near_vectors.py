"""Near duplicates among vectors against all cosines."""

import math
from dataclasses import replace

import numpy as np
import pytest

from pairmill.llm.near_vectors import CellSettings, near_vectors
from pairmill.llm.vectors import kmeans, unit

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cell int"


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 5, 6)
            for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def expected(ids, vectors, threshold=0.95):
    """(id, links, smallest id reachable, kept) of every row by comparing all of them."""
    size = len(ids)
    usual = max({len(v) for v in vectors if v}, key=[len(v) for v in vectors if v].count)
    good = [
        v is not None and len(v) == usual and all(c is not None and math.isfinite(c) for c in v)
        and any(v) for v in vectors
    ]
    linked = np.zeros((size, size), dtype=bool)
    at = np.flatnonzero(good)
    values = unit(np.array([vectors[i] for i in at], dtype=np.float32).astype(float))
    linked[np.ix_(at, at)] = values @ values.T >= threshold
    np.fill_diagonal(linked, False)
    labels = np.array(ids)
    while True:
        new = np.minimum(labels, np.where(linked, labels[None, :], 1 << 60).min(axis=1))
        if (new == labels).all():
            break
        labels = new
    return sorted(
        (int(i), int(n), int(c), bool(i == c)) for i, n, c in zip(ids, linked.sum(axis=1), labels)
    )


def result(found):
    return sorted(tuple(r) for r in found.collect())


def planted(seed, size=1500, length=24):
    """Spread vectors, pairs around the threshold, chains, and a dense group of a third of them."""
    rng = np.random.default_rng(seed)
    vectors = list(rng.normal(size=(size // 2, length)))
    for cosine in np.linspace(0.93, 0.99, size // 6):
        base = unit(rng.normal(size=(1, length)))[0]
        side = rng.normal(size=length)
        side -= (side @ base) * base
        side /= np.linalg.norm(side)
        vectors += [base, 3 * (cosine * base + math.sqrt(1 - cosine**2) * side)]
    centre = rng.normal(size=length)
    while len(vectors) < size * 5 // 4:
        vectors.append(centre + rng.normal(size=length) * np.linalg.norm(centre) * 0.03)
    vectors += [vectors[0]] * 40 + [vectors[-1]] * 30
    ids = rng.permutation(len(vectors)) + 1
    return [int(i) for i in ids], [[float(np.float32(c)) for c in v] for v in vectors]


@pytest.mark.parametrize(
    "cell_rows, block_bytes", [(100_000, 16 << 20), (60, 16 << 20), (60, 1)],
)
def test_whole_margin_finds_all_links(spark, cell_rows, block_bytes):
    ids, vectors = planted(cell_rows)
    settings = CellSettings(
        margin=None, cell_rows=cell_rows, block_bytes=block_bytes, sample_per_cell=4
    )
    assert result(near_vectors(frame(spark, ids, vectors), settings)) == expected(ids, vectors)


def test_blocks_and_dense_groups(spark, monkeypatch):
    monkeypatch.setattr("pairmill.llm.near_vectors.PRODUCT_ROWS", 64)
    ids, vectors = planted(5)
    settings = CellSettings(margin=None, cell_rows=400, block_bytes=1, sample_per_cell=4)
    assert result(near_vectors(frame(spark, ids, vectors), settings)) == expected(ids, vectors)


def test_recall_of_the_usual_margin(spark):
    ids, vectors = planted(7)
    settings = replace(CellSettings(), cell_rows=60, sample_per_cell=4)
    found = dict((r[0], r[1]) for r in result(near_vectors(frame(spark, ids, vectors), settings)))
    wanted = dict((r[0], r[1]) for r in expected(ids, vectors))
    # No link is made up, and nearly none is missed.
    assert all(found[i] <= n for i, n in wanted.items())
    assert sum(found.values()) >= 0.99 * sum(wanted.values())
    missed = sum(1 for i, n in wanted.items() if n and not found[i])
    assert missed <= 0.02 * sum(1 for n in wanted.values() if n)


def test_odd_rows(spark):
    ids = [5, 3, 3, 9, 10, 11, 12, 13, 14, 15, 16, 2]
    vectors = [
        [1, 0, 0], [1, 0, 0], [2, 0, 0], None, [], [0, 0, 0], [1, None, 0], [1, float("nan"), 0],
        [float("inf"), 0, 0], [1, 0], [1e-30, 1e-30, 0], [1e30, 1e30, 0],
    ]
    assert result(near_vectors(frame(spark, ids, vectors))) == expected(ids, vectors)
    nameless = frame(spark, [None, None, 7, None], [[1, 0], [1, 0], [0, 1], [0, 1]])
    found = sorted(near_vectors(nameless).collect(), key=str)
    assert sorted(map(str, found)) == sorted(
        str(r) for r in found
    ) and {(r[0], r[1], r[2], r[3]) for r in found} == {
        (None, 1, None, True), (7, 1, 7, True), (None, 1, 7, False)
    }
    assert result(near_vectors(frame(spark, [], []))) == []


def test_centres_stay_apart():
    rng = np.random.default_rng(1)
    dense = unit(rng.normal(size=32) + rng.normal(size=(4000, 32)) * 0.02)
    spread = unit(rng.normal(size=(2000, 32)))
    centres = kmeans(np.concatenate([dense, spread]), 40, spherical=True, apart=0.8)
    cosines = centres @ centres.T - np.eye(len(centres))
    assert cosines.max() <= 0.8 + 1e-9
    assert (centres @ dense[0] > 0.9).sum() == 1
