"""Near duplicates among embeddings: spherical k-means cells, products inside cells.

1. Vectors are brought to length one. Equal vectors form a class, which counts as one vector with
   a weight; a class is found by a digest, so hot copies are combined where they are read.
2. Spherical k-means on a bounded sample gives the centres of the cells; every vector has the cell of
   its nearest centre as home. Centres keep a distance from each other, so one dense group does not
   spread over many cells.
3. A vector near the border of its cell also goes, as a guest, to the cells beyond. If two vectors
   are linked and have different homes, the line between them crosses the border of these two,
   so at least one of them is no farther from it than half the line. With ``margin`` at that
   half (``whole_margin``) no link can be missed.
4. Inside a cell, cosines are blocked matrix products, residents by residents and residents by
   guests. A pair that could meet in either home is counted in the cell with the smaller number.
   A task sends one count per vector and a spanning forest of its links, never the pairs.
5. A cell with more vectors than a block is cut into blocks, and pairs of blocks are compared in tasks
   of their own. Residents within half the linking angle of the centre are linked with each
   other whatever they are: they are only counted. They are compared neither with each other nor
   with residents beyond one and a half times that angle. So a dense group that holds a third of
   all rows costs its size, not the square of it.
6. Components of the forests; the smallest id of each is its representative.

Vectors that are null, zero or hold a null or non-finite component link with nothing, nor do
vectors of another length than the most common one. A repeated row is a vector of its own and
is linked with its copies; all rows that carry the representative's id are kept. A row without an id is
returned with its links but represents nobody; a component of such rows alone has a null id, and
they are kept. An empty table gives an empty result. Further columns are not read.

Cells grow to more than ``cell_rows`` vectors where the bounds on the sample allow no more centres,
which costs time and loses nothing. On directions that are spread evenly, guests at ``whole_margin``
multiply with the number of cells; ``margin`` then trades them against pairs right at the threshold.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.components import connected_components
from pairmill.llm.vectors import PRODUCT_ROWS, kmeans, matrix, nearest, packed, unit, unpacked, usual_length
from pairmill.session import scratch_path, ship_package

# Keeps decisions by angle on the safe side of those by cosine.
SLACK = 1e-7
PREPARED = "id long, digest binary, vector binary"
PLACED = (
    "node long, weight long, cell int, home int, cells array<int>, angle double, vector binary"
)
FOUND = "a long, b long, links long"


@dataclass(frozen=True)
class CellSettings:
    """``margin``: how far beyond the border of its cell, as a distance, a vector is looked for;
    None for the margin that misses nothing. ``sample_bytes`` bounds what the centres are fit on
    and, with one centre per ``sample_per_cell`` of its vectors, what is broadcast."""

    threshold: float = 0.95
    margin: float | None = 0.05
    cell_rows: int = 4096
    sample_bytes: int = 32 << 20
    sample_per_cell: int = 16
    block_bytes: int = 16 << 20

    @property
    def angle(self) -> float:
        return math.acos(self.threshold)

    @property
    def whole_margin(self) -> float:
        return math.sin(self.angle / 2) + SLACK


def _prepared(vectors: DataFrame, id_column: str, vector_column: str, length: int, dtype: str):
    def prepare(batches):
        for batch in batches:
            rows, values = matrix(batch.column(1), length)
            nonzero = (values != 0).any(axis=1)
            rows, values = rows[nonzero], values[nonzero]
            # Adding zero turns -0.0 into 0.0.
            raw = (values + 0.0).astype(dtype)
            digest = np.full(batch.num_rows, None, dtype=object)
            vector = digest.copy()
            digest[rows] = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in raw]
            vector[rows] = [row.tobytes() for row in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(vector, pa.binary())],
                ["id", "digest", "vector"],
            )

    return vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")
    ).mapInArrow(prepare, PREPARED)


def _centres(classes: DataFrame, count: int, length: int, dtype: str, settings: CellSettings):
    """Centres of the cells, fit on the driver from at most about ``sample_bytes``."""
    wanted = -(-count // settings.cell_rows)
    if wanted <= 1:
        return np.zeros((1, length))
    most = settings.sample_bytes // (8 * length)
    sample = classes.select("node", "vector")
    if count > most:
        spread = F.pmod(F.xxhash64("node", F.lit("cells")), F.lit(1 << 40))
        sample = sample.where(spread < int((1 << 40) * most / count))
    drawn = sample.orderBy("node").select("vector").toArrow()
    values = unit(unpacked(drawn.column("vector"), dtype))
    cells = max(1, min(wanted, len(values) // settings.sample_per_cell))
    # Two centres this far apart never share a group whose vectors are all linked.
    return kmeans(values, cells, spherical=True, apart=math.cos(2 * settings.angle))


def _neighbour_cells(values: np.ndarray, centres: np.ndarray, margin: float):
    """Home of each vector, and (row, cell) of all cells it belongs to, its home among them."""
    homes = nearest(values, centres, spherical=True)
    rows, cells = [], []
    for home in np.unique(homes):
        inside = np.flatnonzero(homes == home)
        gaps = np.sqrt(np.maximum(2 - 2 * centres @ centres[home], 1e-12))
        products = values[inside] @ centres.T
        near = (products[:, [home]] - products) / gaps <= margin
        near[:, home] = True
        at, cell = np.nonzero(near)
        rows.append(inside[at])
        cells.append(cell)
    return homes, np.concatenate(rows), np.concatenate(cells)


def _placed(classes: DataFrame, centres: np.ndarray, dtype: str, margin: float) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def place(batches):
        centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            values = unit(unpacked(batch.column("vector"), dtype))
            homes, rows, cells = _neighbour_cells(values, centres, margin)
            order = np.lexsort([cells, rows])
            rows, cells = rows[order], cells[order]
            bounds = np.searchsorted(rows, np.arange(len(values) + 1))
            lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(cells, pa.int32()))
            cosines = np.einsum("ij,ij->i", values[rows], centres[cells])
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(taken), batch.column("weight").take(taken),
                    pa.array(cells, pa.int32()), pa.array(homes[rows], pa.int32()),
                    lists.take(taken), pa.array(np.arccos(np.clip(cosines, -1, 1))),
                    batch.column("vector").take(taken),
                ],
                ["node", "weight", "cell", "home", "cells", "angle", "vector"],
            )

    return classes.select("node", "weight", "vector").mapInArrow(place, PLACED)


class Links:
    """Weighted counts of links per row, and one label per connected rows."""

    def __init__(self, size: int):
        self.counts = np.zeros(size, dtype=np.int64)
        self.labels = np.arange(size)

    def add(self, left: np.ndarray, right: np.ndarray, linked: np.ndarray, weights: np.ndarray):
        """``linked`` says which rows of ``left`` are linked with which of ``right``."""
        i, j = np.nonzero(linked)
        if not len(i):
            return
        i, j = left[i], right[j]
        np.add.at(self.counts, i, weights[j])
        np.add.at(self.counts, j, weights[i])
        labels = self.labels
        while True:
            a, b = labels[i], labels[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                return
            np.minimum.at(labels, high, low)
            while (labels[labels] != labels).any():
                labels[:] = labels[labels]


def _counted(cells: list, homes: np.ndarray, cell: int, left: np.ndarray, right: np.ndarray):
    """Which pairs of a resident of ``cell`` and a guest are counted here.

    All but those that also meet in the guest's home, if its number is smaller.
    """
    counted = np.ones((len(left), len(right)), dtype=bool)
    for home in np.unique(homes[right]):
        if home < cell:
            there = np.array([home in cells[x] for x in left])
            counted[np.ix_(there, homes[right] == home)] = False
    return counted


def _links(rows: pa.Table, dtype: str, threshold: float, left: np.ndarray, right: np.ndarray,
           same: bool) -> pa.Table:
    """Counts and forest of the links between residents ``left`` and the rows ``right``.

    ``same``: the residents are compared with each other as well as with ``right``.
    """
    nodes = rows.column("node").to_numpy()
    weights = rows.column("weight").to_numpy()
    homes = rows.column("home").to_numpy()
    cells = rows.column("cells").to_pylist()
    cell = rows.column("cell")[0].as_py() if rows.num_rows else 0
    values = unit(unpacked(rows.column("vector"), dtype))
    links = Links(len(nodes))
    for i in range(0, len(left), PRODUCT_ROWS):
        a = left[i : i + PRODUCT_ROWS]
        if same:
            for j in range(i, len(left), PRODUCT_ROWS):
                b = left[j : j + PRODUCT_ROWS]
                linked = values[a] @ values[b].T >= threshold
                links.add(a, b, np.triu(linked, 1) if i == j else linked, weights)
        for j in range(0, len(right), PRODUCT_ROWS):
            b = right[j : j + PRODUCT_ROWS]
            linked = values[a] @ values[b].T >= threshold
            if linked.any():
                linked &= _counted(cells, homes, cell, a, b)
                links.add(a, b, linked, weights)
    hit = np.flatnonzero(links.counts)
    return pa.table(
        [pa.array(nodes[hit]), pa.array(nodes[links.labels[hit]]), pa.array(links.counts[hit])],
        names=["a", "b", "links"],
    )


# Parts of a cell in blocks: residents that are linked with each other by their place alone, those that
# may be linked with such, those that cannot be, and guests.
CORE, SHELL, FAR, GUEST = range(4)


def _cell_links(placed: DataFrame, dtype: str, length: int, settings: CellSettings) -> DataFrame:
    """(a, b, links): parts of the count of node a, and a node b it is connected with."""
    threshold = settings.threshold
    block_rows = max(PRODUCT_ROWS, settings.block_bytes // (8 * length))
    resident = F.col("cell") == F.col("home")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("size"))
    sized = placed.join(sizes, "cell")

    def whole(rows: pa.Table) -> pa.Table:
        here = rows.column("home").to_numpy() == rows.column("cell").to_numpy()
        return _links(rows, dtype, threshold, np.flatnonzero(here), np.flatnonzero(~here), True)

    columns = ["cell", "node", "weight", "home", "cells", "vector"]
    few = sized.where(F.col("size") <= block_rows).select(columns)
    found = few.groupBy("cell").applyInArrow(whole, FOUND)

    # Larger cells, in blocks.
    half = settings.angle / 2
    part = (
        F.when(~resident, GUEST)
        .when(F.col("angle") <= half - SLACK, CORE)
        .when(F.col("angle") <= 3 * half + SLACK, SHELL)
        .otherwise(FAR)
    )
    many = sized.where(F.col("size") > block_rows).withColumn("part", part)
    parts = many.groupBy("cell", "part").agg(
        F.count("*").alias("n"), F.sum("weight").alias("total"), F.min("node").alias("first")
    )
    core = (
        many.where(F.col("part") == CORE).select("cell", "node", "weight")
        .join(parts.where(F.col("part") == CORE).select("cell", "total", "first"), "cell")
        .where(F.col("total") > F.col("weight"))
        .select(F.col("node").alias("a"), F.col("first").alias("b"),
                (F.col("total") - F.col("weight")).alias("links"))
    )
    blocks = parts.withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    listed = blocks.select(
        "cell", "part", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    x, y = listed.alias("x"), listed.alias("y")
    p, q = F.col("x.part"), F.col("y.part")
    ordered = (p < q) | ((p == q) & (F.col("x.block") <= F.col("y.block")))
    compared = ordered & (p != GUEST) & ~((p == CORE) & q.isin(CORE, FAR))
    pairs = x.join(y, F.col("x.cell") == F.col("y.cell")).where(compared).select(
        F.col("x.cell").alias("cell"),
        F.struct(p.alias("part"), F.col("x.block").alias("block")).alias("left"),
        F.struct(q.alias("part"), F.col("y.block").alias("block")).alias("right"),
    )
    sides = pairs.select(
        "cell", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("side")
    ).select(
        "cell", F.col("left.part").alias("lp"), F.col("left.block").alias("lb"),
        F.col("right.part").alias("rp"), F.col("right.block").alias("rb"),
        F.col("side.part").alias("part"), F.col("side.block").alias("block"),
    )
    numbered = many.join(blocks.select("cell", "part", "blocks"), ["cell", "part"]).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    )
    sent = sides.join(numbered, ["cell", "part", "block"]).select(
        "lp", "lb", "rp", "rb", "part", "block", *columns
    )

    def two(rows: pa.Table) -> pa.Table:
        lp, lb, rp, rb = (rows.column(c)[0].as_py() for c in ("lp", "lb", "rp", "rb"))
        here = (rows.column("part").to_numpy() == lp) & (rows.column("block").to_numpy() == lb)
        same = (lp, lb) == (rp, rb)
        return _links(rows, dtype, threshold, np.flatnonzero(here), np.flatnonzero(~here), same)

    pairs_found = sent.groupBy("cell", "lp", "lb", "rp", "rb").applyInArrow(two, FOUND)
    return found.unionByName(pairs_found).unionByName(core)


def near_vectors(
    vectors: DataFrame, settings: CellSettings = CellSettings(), id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; see the module."""
    spark = vectors.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "vectors")
    kind = vectors.schema[vector_column].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"
    length = usual_length(vectors, vector_column)
    prepared = _prepared(vectors, id_column, vector_column, length, dtype)
    # The number of a row is only good once it is written.
    prepared.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    (
        rows.where(F.col("digest").isNotNull()).groupBy("digest")
        .agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.min("id").alias("least"))
        .write.parquet(f"{root}/classes")
    )
    classes = spark.read.parquet(f"{root}/classes")
    count = classes.count()

    links = spark.createDataFrame([], FOUND)
    if count > 1:
        units = classes.select("node", "weight").join(
            rows.select(F.col("row").alias("node"), "vector"), "node"
        )
        centres = _centres(units, count, length, dtype, settings)
        margin = settings.whole_margin if settings.margin is None else settings.margin
        _placed(units, centres, dtype, margin).write.parquet(f"{root}/placed")
        placed = spark.read.parquet(f"{root}/placed")
        _cell_links(placed, dtype, length, settings).write.parquet(f"{root}/links")
        links = spark.read.parquet(f"{root}/links")

    groups = connected_components(links.where("a <> b").select("a", "b"))
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = classes.join(groups, "node", "left").join(counts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    told = known.join(named, "component").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id", F.lit(True).alias("known"),
    )
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    result = rows.select("id", "digest").join(told, "digest", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
