"""Hard negatives of anchors, searched in an inverted multi-index.

Scores are inner products of vectors of whole numbers. The positives of an anchor are the best
other rows of its label; a hard negative of a positive is one of the best rows of other labels whose
score lies in a window given by the positive's score.

1. A codebook for either half of the components is fit on a bounded sample. A row's cell is
   its pair of codewords. The radius of a codeword is the distance of its farthest half, over all rows.
2. Cells are put together into shards of a bounded number of rows; a hot cell is split over several.
3. The half-score of a codeword is its product with the anchor's half plus radius times the length of
   that half, so the sum of two half-scores is a bound on every row of a cell. A search of a shard
   visits cells by falling sums, with a heap over the two sorted lists of half-scores, and stops once
   the bound shows that nothing can enter what was found: the best positives, or the best
   negatives of every window.
4. Every anchor first searches the shard of its best cell. What it found there bounds what other
   shards must offer, and only to shards that can offer it the anchor is sent. This is done for
   positives, whose scores make the windows, and then for negatives. Results are exact.

Rows without an id, label or vector, with a null or non-finite component, or with another length than
the most common one take no part; nor do rows with a component so large that a product might not
fit a long (4e8 at 64 components). Equal scores rank by id. A repeated row is a row of its
own, but no row is a positive of an anchor with its id, and of anchors sharing an id the least by label and
vector counts. An empty table, or one without anchors or positives, gives an empty result. Further
columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.llm.vectors import kmeans, matrix, nearest, packed, unpacked, usual_length
from pairmill.session import scratch_path, ship_package

ROW = "vec_id long, label long, vector binary"
INDEXED = f"{ROW}, c1 int, c2 int, d1 double, d2 double"
WINDOWS = "array<struct<place: int, score: long, third: long>>"
ANCHOR = f"anchor_id long, label long, vector binary, need long, windows {WINDOWS}"
# Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


@dataclass(frozen=True)
class IndexSettings:
    """``sample_bytes`` bounds what the codebooks are fit on."""

    codewords: int = 16
    sample_bytes: int = 16 << 20
    shard_rows: int = 20_000
    block_anchors: int = 10_000


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 3
    # A negative has at least and at most these hundredths of its positive's score.
    low: int = 50
    high: int = 95
    scale: int = 256

    def window(self, score: int) -> tuple[int, int]:
        return -(-self.low * score // 100), self.high * score // 100


def _whole_rows(vectors: DataFrame, columns: tuple, length: int, scale: int) -> DataFrame:
    limit = min(math.isqrt(((1 << 63) - 1) // max(length, 1)), (1 << 31) - 1)

    def whole(batches):
        for batch in batches:
            rows, values = matrix(batch.column(2), length)
            values = np.floor(scale * values)
            fits = (np.abs(values) <= limit).all(axis=1)
            rows, values = pa.array(rows[fits]), values[fits].astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), packed(values)],
                ["vec_id", "label", "vector"],
            )

    id_column, label_column, vector_column = columns
    known = vectors.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    return known.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).alias("vector"),
    ).mapInArrow(whole, ROW)


class Codebooks:
    """Codewords of both halves and, once known, their radii and the cells with their shards."""

    def __init__(self, sample: np.ndarray, length: int, codewords: int):
        self.half = (length + 1) // 2
        self.words = [
            kmeans(part, codewords, spherical=False) if part.shape[1] and len(part)
            else np.zeros((1, part.shape[1]))
            for part in self.split(sample)
        ]

    def split(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return values[:, : self.half], values[:, self.half :]

    def codes(self, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Codeword of each row's halves, and the distance from it."""
        found = []
        for part, words in zip(self.split(values), self.words):
            code = nearest(part, words, spherical=False)
            found.append((code, np.sqrt(((part - words[code]) ** 2).sum(axis=1))))
        return found

    def fill(self, cells: list, shard_rows: int) -> None:
        """``cells``: (c1, c2, rows, largest d1, largest d2) of every cell that has rows."""
        self.radii = [np.zeros(len(words)) for words in self.words]
        self.cells = np.array([c[:2] for c in cells], dtype=np.int64).reshape(-1, 2)
        self.first, self.parts = [], []
        shard, room = -1, 0
        for c1, c2, n, d1, d2 in cells:
            self.radii[0][c1] = max(self.radii[0][c1], d1)
            self.radii[1][c2] = max(self.radii[1][c2], d2)
            parts = -(-n // shard_rows)
            if parts > 1 or n > room:
                shard, room = shard + 1, shard_rows
            self.first.append(shard)
            self.parts.append(parts)
            shard, room = (shard + parts - 1, 0) if parts > 1 else (shard, room - n)

    def half_scores(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds on the product of each row's halves with any half of each codeword.

        A little more than that, for the rounding of doubles.
        """
        found = []
        for part, words, radii in zip(self.split(values), self.words, self.radii):
            norms = np.sqrt((part * part).sum(axis=1))
            reach = np.sqrt((words * words).sum(axis=1)) + radii
            found.append(
                part @ words.T + np.outer(norms, radii) + 1e-9 * np.outer(norms, reach) + 1e-6
            )
        return found[0], found[1]


class Shard:
    """The rows of some cells, ordered by cell."""

    def __init__(self, rows: pa.Table):
        c1, c2 = rows.column("c1").to_numpy(), rows.column("c2").to_numpy()
        order = np.lexsort([c2, c1])
        self.ids = rows.column("vec_id").to_numpy()[order]
        self.labels = rows.column("label").to_numpy()[order]
        self.values = unpacked(rows.column("vector"), "<i4")[order]
        c1, c2 = c1[order], c2[order]
        starts = np.flatnonzero(np.r_[True, (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])])
        ends = np.r_[starts[1:], len(c1)]
        self.spans = {
            (int(c1[s]), int(c2[s])): (int(s), int(e)) for s, e in zip(starts, ends)
        }
        self.codes = np.unique(c1), np.unique(c2)
        self.largest = float(np.abs(self.values).max(initial=0))
        self._integers = None

    def scores(self, start: int, end: int, anchor: np.ndarray) -> np.ndarray:
        bound = self.largest * float(np.abs(anchor).max(initial=0)) * max(len(anchor), 1)
        if bound < EXACT:
            return (self.values[start:end] @ anchor).astype(np.int64)
        if self._integers is None:
            self._integers = self.values.astype(np.int64)
        return self._integers[start:end] @ anchor.astype(np.int64)

    def visit(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Bound and rows of the cells by falling sums of an anchor's half-scores."""
        lists = []
        for scores, codes in zip((first, second), self.codes):
            order = codes[np.argsort(-scores[codes], kind="stable")]
            lists.append((scores[order].tolist(), order.tolist()))
        (a, a_codes), (b, b_codes) = lists
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            negative, i, j = heapq.heappop(heap)
            span = self.spans.get((a_codes[i], b_codes[j]))
            if span:
                yield -negative, *span
            # Each pair of places is pushed once: along the first column, then along rows.
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


class Best:
    """The best few (score, id) so far, the smaller id first among equal scores."""

    def __init__(self, most: int):
        self.most = most
        self.found: list[tuple[int, int]] = []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.most:
            order = np.lexsort([ids, -scores])[: self.most]
            scores, ids = scores[order], ids[order]
        merged = self.found + list(zip(scores.tolist(), ids.tolist()))
        self.found = sorted(merged, key=lambda x: (-x[0], x[1]))[: self.most]

    @property
    def last(self) -> int | None:
        """The score that a newcomer must reach, if there is one."""
        return self.found[-1][0] if len(self.found) == self.most else None


def _table(rows: list, schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


class Positives:
    """The best rows of an anchor's label."""

    schema = "anchor_id long, id long, score long"

    def __init__(self, mining: Mining):
        self.mining = mining

    def need(self, anchor: dict) -> int | None:
        return anchor["need"]

    def search(self, shard: Shard, anchor: dict, value: np.ndarray, halves, out: list) -> None:
        best, need = Best(self.mining.positives), anchor["need"]
        for bound, start, end in shard.visit(*halves):
            if need is not None and bound < need:
                break
            hit = np.flatnonzero(
                (shard.labels[start:end] == anchor["label"])
                & (shard.ids[start:end] != anchor["anchor_id"])
            )
            if not len(hit):
                continue
            scores = shard.scores(start, end, value)[hit]
            if need is not None:
                hit, scores = hit[scores >= need], scores[scores >= need]
            best.add(scores, shard.ids[start:end][hit])
            if best.last is not None:
                need = best.last if need is None else max(need, best.last)
        out.extend((anchor["anchor_id"], i, s) for s, i in best.found)

    def table(self, out: list) -> pa.Table:
        kind = pa.int64()
        return _table(out, [("anchor_id", kind), ("id", kind), ("score", kind)])


class Negatives:
    """For each positive of an anchor the best rows of other labels inside its window."""

    schema = "anchor_id long, place int, id long, score long"

    def __init__(self, mining: Mining):
        self.mining = mining

    def _windows(self, anchor: dict) -> list:
        """(place, lowest, highest score, score to reach) of the windows that hold a number."""
        found = []
        for w in anchor["windows"]:
            low, high = self.mining.window(w["score"])
            if low <= high:
                found.append((w["place"], low, high, low if w["third"] is None else w["third"]))
        return found

    def need(self, anchor: dict) -> int | None:
        # Without any window nothing is needed: no score reaches this.
        return min((w[3] for w in self._windows(anchor)), default=1 << 63)

    def search(self, shard: Shard, anchor: dict, value: np.ndarray, halves, out: list) -> None:
        windows = [(*w, Best(self.mining.negatives)) for w in self._windows(anchor)]
        if not windows:
            return
        reach = [w[3] for w in windows]
        for bound, start, end in shard.visit(*halves):
            need = min(reach)
            if bound < need:
                break
            scores = shard.scores(start, end, value)
            hit = np.flatnonzero((scores >= need) & (shard.labels[start:end] != anchor["label"]))
            if not len(hit):
                continue
            scores, ids = scores[hit], shard.ids[start:end][hit]
            for k, (_, _, high, _, best) in enumerate(windows):
                inside = (scores >= reach[k]) & (scores <= high)
                if inside.any():
                    best.add(scores[inside], ids[inside])
                    if best.last is not None:
                        reach[k] = max(reach[k], best.last)
        for place, _, _, _, best in windows:
            out.extend((anchor["anchor_id"], place, i, s) for s, i in best.found)

    def table(self, out: list) -> pa.Table:
        kind = pa.int64()
        return _table(
            out, [("anchor_id", kind), ("place", pa.int32()), ("id", kind), ("score", kind)]
        )


def _routed(anchors: DataFrame, shared, seeker, first: bool) -> DataFrame:
    """Each anchor beside the shard of its best cell, or all other shards that can offer something."""

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            books = shared.value
            s1, s2 = books.half_scores(unpacked(batch.column("vector"), "<i4"))
            bounds = s1[:, books.cells[:, 0]] + s2[:, books.cells[:, 1]]
            best = bounds.argmax(axis=1)
            rows, shards = [], []
            for k, anchor in enumerate(_anchors(batch)):
                need = seeker.need(anchor)
                cell = best[k]
                own = books.first[cell] + anchor["anchor_id"] % books.parts[cell]
                if first:
                    wanted = {own} if need is None or bounds[k, cell] >= need else set()
                else:
                    open_cells = range(len(bounds[k])) if need is None else np.flatnonzero(bounds[k] >= need)
                    wanted = {
                        books.first[c] + p for c in open_cells for p in range(books.parts[c])
                    } - {own}
                rows += [k] * len(wanted)
                shards += sorted(wanted)
            sent = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*sent.columns, pa.array(shards, pa.int32())], [*sent.schema.names, "shard"]
            )

    return anchors.mapInArrow(route, f"{ANCHOR}, shard int")


def _anchors(batch) -> list[dict]:
    return batch.select(["anchor_id", "label", "need", "windows"]).to_pylist()


def _wave(index: DataFrame, anchors: DataFrame, shared, seeker, first: bool, block: int) -> DataFrame:
    """What the anchors find in the shards that they are sent to."""
    routed = _routed(anchors, shared, seeker, first)
    blocks = routed.groupBy("shard").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks")
    )
    dealt = routed.join(blocks, "shard").withColumn(
        "block", F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int")
    ).drop("blocks")
    rows = index.join(blocks, "shard").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).drop("blocks")

    def search(asking: pa.Table, held: pa.Table) -> pa.Table:
        out: list = []
        if asking.num_rows and held.num_rows:
            shard = Shard(held)
            values = unpacked(asking.column("vector"), "<i4")
            s1, s2 = shared.value.half_scores(values)
            for k, anchor in enumerate(_anchors(asking)):
                seeker.search(shard, anchor, values[k], (s1[k], s2[k]), out)
        return seeker.table(out)

    # A search costs far more than its bytes tell, so small partitions are not put together.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [side.repartition(tasks, "shard", "block") for side in (dealt, rows)]
    return sides[0].groupBy("shard", "block").cogroup(sides[1].groupBy("shard", "block")).applyInArrow(
        search, seeker.schema
    )


def _index(rows: DataFrame, length: int, root: str, settings: IndexSettings):
    """(rows with their shards, broadcast codebooks)."""
    spark = rows.sparkSession
    count = rows.count()
    most = settings.sample_bytes // (8 * max(length, 1))
    sample = rows.select("vec_id", "vector")
    if count > most:
        spread = F.pmod(F.xxhash64("vec_id", F.lit("words")), F.lit(1 << 40))
        sample = sample.where(spread < int((1 << 40) * most / count))
    drawn = sample.select("vector").toArrow().column("vector")
    values = unpacked(drawn, "<i4") if len(drawn) else np.zeros((0, length))
    books = Codebooks(values, length, settings.codewords)
    words = spark.sparkContext.broadcast(books)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            (c1, d1), (c2, d2) = words.value.codes(unpacked(batch.column("vector"), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(c1, pa.int32()), pa.array(c2, pa.int32()),
                 pa.array(d1), pa.array(d2)],
                [*batch.schema.names, "c1", "c2", "d1", "d2"],
            )

    rows.mapInArrow(assign, INDEXED).write.parquet(f"{root}/index")
    index = spark.read.parquet(f"{root}/index")
    # At most codewords squared rows.
    cells = index.groupBy("c1", "c2").agg(
        F.count("*"), F.max("d1"), F.max("d2")
    ).orderBy("c1", "c2").collect()
    books.fill([tuple(c) for c in cells], settings.shard_rows)
    places = spark.createDataFrame(
        [(int(a), int(b), f, p) for (a, b), f, p in zip(books.cells, books.first, books.parts)],
        "c1 int, c2 int, first int, parts int",
    )
    part = F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col("parts")).cast("int")
    placed = index.join(F.broadcast(places), ["c1", "c2"]).select(
        "vec_id", "label", "vector", "c1", "c2", (F.col("first") + part).alias("shard")
    )
    return placed, spark.sparkContext.broadcast(books)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, mining: Mining = Mining(),
    settings: IndexSettings = IndexSettings(), id_column: str = "vec_id",
    label_column: str = "label", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id`` and ``label``; see the module for the rest.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "negatives")
    length = usual_length(vectors, vector_column)
    columns = (id_column, label_column, vector_column)
    _whole_rows(vectors, columns, length, mining.scale).write.parquet(f"{root}/rows")
    rows = spark.read.schema(ROW).parquet(f"{root}/rows")
    index, shared = _index(rows, length, root, settings)

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    least = F.min(F.struct("label", "vector")).alias("least")
    anchors = written(
        rows.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(least)
        .select("anchor_id", "least.label", "least.vector"), "anchors",
    )

    def waves(asking: DataFrame, state, seeker, name: str) -> DataFrame:
        """Both waves of a search; ``state`` adds what the first one found to the anchors."""
        block = settings.block_anchors
        start = asking.select("anchor_id", "label", "vector", "need", "windows")
        one = written(_wave(index, start, shared, seeker, True, block), f"{name}1")
        two = _wave(index, state(asking, one), shared, seeker, False, block)
        return one.unionByName(written(two, f"{name}2"))

    none = F.lit(None).cast(WINDOWS).alias("windows")
    asking = anchors.select("*", F.lit(None).cast("long").alias("need"), none)

    def with_need(asking: DataFrame, one: DataFrame) -> DataFrame:
        reached = one.groupBy("anchor_id").agg(
            F.when(F.count("*") >= mining.positives, F.min("score")).alias("need")
        )
        return asking.drop("need").join(reached, "anchor_id", "left").select(
            "anchor_id", "label", "vector", "need", "windows"
        )

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    positives = written(
        waves(asking, with_need, Positives(mining), "positives")
        .withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") <= mining.positives), "positives",
    )

    def with_windows(thirds: DataFrame | None) -> DataFrame:
        told = positives.withColumn("third", F.lit(None).cast("long")) if thirds is None else (
            positives.join(thirds, ["anchor_id", "place"], "left"))
        # As many as an anchor has positives.
        windows = told.groupBy("anchor_id").agg(
            F.array_sort(F.collect_list(F.struct("place", "score", "third"))).cast(WINDOWS)
            .alias("windows")
        )
        return anchors.join(windows, "anchor_id").select(
            "anchor_id", "label", "vector", F.lit(None).cast("long").alias("need"), "windows"
        )

    def with_thirds(_: DataFrame, one: DataFrame) -> DataFrame:
        return with_windows(one.groupBy("anchor_id", "place").agg(
            F.when(F.count("*") >= mining.negatives, F.min("score")).alias("third")
        ))

    inside = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    negatives = (
        waves(with_windows(None), with_thirds, Negatives(mining), "negatives")
        .withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= mining.negatives)
        .select("anchor_id", "place", "rank", F.col("id").alias("negative_id"),
                F.col("score").alias("negative_score"))
    )
    return positives.join(negatives, ["anchor_id", "place"]).select(
        "anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
