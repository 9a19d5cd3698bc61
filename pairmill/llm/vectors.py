"""Vectors in Arrow columns, and k-means on a bounded sample of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Products are made in blocks of so many rows a side.
PRODUCT_ROWS = 1024


def usual_length(vectors: DataFrame, column: str) -> int:
    """The most common length of the vectors, the smaller of two; 0 without any vector."""
    sizes = vectors.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("size"))
    first = sizes.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return first["size"] if first else 0


def matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values): the vectors of this length whose components are all finite numbers.

    ``rows`` are their places in the column, ``values`` their components in double precision.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == length)
    if not len(rows) or not length:
        return rows[:0], np.zeros((0, length))
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), length)
    finite = np.isfinite(values).all(axis=1)
    return rows[finite], values[finite]


def packed(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    flat = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(values), [None, pa.py_buffer(values)]
    )
    return flat.cast(pa.binary())


def unpacked(column, dtype: str) -> np.ndarray:
    """The matrix whose rows ``packed`` made, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return np.array([np.frombuffer(v.as_buffer(), dtype) for v in column], dtype=np.float64)


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows of zeros stay."""
    largest = np.abs(values).max(axis=1, keepdims=True) if values.size else values[:, :1]
    scaled = values / np.where(largest > 0, largest, 1)
    norms = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(norms > 0, norms, 1)


def nearest(values: np.ndarray, centres: np.ndarray, spherical: bool) -> np.ndarray:
    """The centre with the largest inner product, or with the smallest distance."""
    shift = 0 if spherical else -0.5 * (centres * centres).sum(axis=1)
    found = np.empty(len(values), dtype=np.int64)
    for first in range(0, len(values), PRODUCT_ROWS):
        part = slice(first, first + PRODUCT_ROWS)
        found[part] = (values[part] @ centres.T + shift).argmax(axis=1)
    return found


def kmeans(
    values: np.ndarray, count: int, spherical: bool, apart: float = 1.0, rounds: int = 8,
    seed: int = 17,
) -> np.ndarray:
    """Centres of at most ``count`` clusters of the rows.

    Spherical centres have length one, and none has a cosine above ``apart`` with another, so a
    dense group gets one centre even if it holds most of the rows.
    """
    if not len(values) or count <= 1:
        centre = values.mean(axis=0, keepdims=True) if len(values) else values[:0]
        return unit(centre) if spherical else centre
    order = np.random.default_rng(seed).permutation(len(values))
    centres = values[order[: count if apart >= 1 else min(len(values), 4 * count)]]
    centres = _separate(centres, apart)[:count] if spherical else np.unique(centres, axis=0)
    for _ in range(rounds):
        home = nearest(values, centres, spherical)
        sums = np.zeros((len(centres), values.shape[1]))
        np.add.at(sums, home, values)
        sizes = np.bincount(home, minlength=len(centres))
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        centres = sums[order] / sizes[order, None]
        if spherical:
            centres = _separate(unit(centres), apart)
    return centres


def _separate(centres: np.ndarray, apart: float) -> np.ndarray:
    """Without those too near to an earlier one."""
    if apart >= 1:
        return centres
    kept = np.empty_like(centres)
    size = 0
    for centre in centres:
        if not size or (kept[:size] @ centre).max() <= apart:
            kept[size] = centre
            size += 1
    return kept[:size]
