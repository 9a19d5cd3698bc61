"""Packing documents into training sequences: best fit, then swap-based local search."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.scan import release, slices
from pairmill.llm.transducer import texts_of, transducer
from pairmill.llm.vocabulary import broadcast_vocabulary
from pairmill.session import scratch_path, ship_package

CAPACITY = 2048
# Pieces that one task packs. Groups are dealt evenly, so this bounds a task's memory.
GROUP_PIECES = 20_000
# Sequences filled less than this are opened again and packed with those of other groups.
REOPEN_BELOW = 0.995
# Exchanges tried by one task before its packing stands as it is.
SEARCH_STEPS = 400_000


def token_pieces(
    documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = 0,
    id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens, each closed by ``end_id``.

    Rows (id, piece, start, length, ids_crc32); with ``keep_ids`` also ``ids``, the little-endian
    32-bit token numbers. Null and empty texts are the one token ``end_id``.
    """
    spark = documents.sparkSession
    ship_package(spark)
    shared = broadcast_vocabulary(spark, vocabulary_path)
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches):
        machine = transducer(shared.value)
        end = np.array([end_id], dtype=np.int32)
        for batch in batches:
            for part in slices(batch.column(1)):
                rows, pieces, starts, lengths, sums, contents = [], [], [], [], [], []
                for row, ids in enumerate(machine.encode(texts_of(part)), part.first):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        content = ids[start : start + capacity].tobytes()
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(len(content) // 4)
                        sums.append(zlib.crc32(content))
                        if keep_ids:
                            contents.append(content)
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                ]
                names = ["_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(contents, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(run, schema + ", ids binary" * keep_ids).withColumnRenamed(
        "_id", id_column
    )


class Rooms:
    """Bins by the room left in them; finds the tightest that still takes a length."""

    def __init__(self, capacity: int):
        self.at = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, room: int, number: int) -> None:
        self.at[room].append(number)
        self.mask |= 1 << room

    def take(self, length: int) -> int | None:
        fitting = self.mask >> length
        if not fitting:
            return None
        room = length + (fitting & -fitting).bit_length() - 1
        number = self.at[room].pop()
        if not self.at[room]:
            self.mask &= ~(1 << room)
        return number


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: the longest first, each into the fullest bin that takes it."""
    rooms, bins, left = Rooms(capacity), [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        number = rooms.take(lengths[item])
        if number is None:
            number = len(bins)
            bins.append([])
            left.append(capacity)
        bins[number].append(item)
        left[number] -= lengths[item]
        if left[number]:
            rooms.add(left[number], number)
    return bins


class LocalSearch:
    """Empties underfull bins, the least filled first, into the other underfull ones.

    A step moves one item, exchanges one for one, or one for two, and is taken only if the bin it
    fills ends fuller than the bin it empties was: so the sum of squared fills rises with every
    step and the search ends. It also ends when the room outside a bin is less than its content,
    or after ``steps`` tried bins.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int, steps: int):
        self.capacity, self.steps = capacity, steps
        self.full, self.open = [], []
        for items in bins:
            room = capacity - sum(lengths[i] for i in items)
            if room:
                # Items by length, and the room left beside them.
                self.open.append((sorted((lengths[i], i) for i in items), room))
            else:
                self.full.append(items)

    def run(self) -> list[list[int]]:
        contents = [content for content, _ in self.open]
        rooms = [room for _, room in self.open]
        stuck = False
        while not stuck and self.steps > 0:
            stuck, spare = True, sum(rooms)
            for source in sorted(range(len(rooms)), key=rooms.__getitem__, reverse=True):
                if not contents[source]:
                    continue
                # Emptying it needs at least as much room in the others.
                if spare - rooms[source] < self.capacity - rooms[source] or self.steps <= 0:
                    break
                if self._empty(source, contents, rooms):
                    stuck = False
                    spare -= self.capacity
                    rooms[source] = 0
        return self.full + [[i for _, i in content] for content in contents if content]

    def _empty(self, source: int, contents, rooms) -> bool:
        moved = True
        while contents[source] and moved and self.steps > 0:
            moved = any(
                self._place(source, given, contents, rooms)
                for given in sorted(contents[source], reverse=True)
            )
        return not contents[source]

    def _place(self, source: int, given, contents, rooms) -> bool:
        """Takes the step that brings the most of one item's length into another bin."""
        length, best = given[0], None
        for number, room in enumerate(rooms):
            if not room or number == source or self.steps <= 0:
                continue
            self.steps -= 1
            back = () if room >= length else self._exchange(contents[number], length, room)
            if back is None:
                continue
            gain = length - sum(x[0] for x in back)
            if room - gain < rooms[source] and (best is None or gain > best[0]):
                best = gain, number, back
                if not back or gain == room:
                    break
        if best is None:
            return False
        gain, number, back = best
        contents[source].remove(given)
        for x in back:
            contents[number].remove(x)
            insort(contents[source], x)
        insort(contents[number], given)
        rooms[number] -= gain
        rooms[source] += gain
        return True

    def _exchange(self, content, length: int, room: int):
        """One or two items shorter than ``length`` together, by as much of ``room`` as can be."""
        least = length - room
        at = bisect_left(content, (least, -1))
        single = content[at] if at < len(content) and content[at][0] < length else None
        if single and single[0] == least:
            return (single,)
        low, high, pair = 0, len(content) - 1, None
        while low < high:
            total = content[low][0] + content[high][0]
            if total >= least:
                if total < length and (pair is None or total < pair[0][0] + pair[1][0]):
                    pair = content[low], content[high]
                high -= 1
            else:
                low += 1
        if pair and (single is None or pair[0][0] + pair[1][0] < single[0]):
            return pair
        return (single,) if single else None


def pack(lengths, capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Item numbers by bin, in few bins of at most ``capacity``."""
    lengths = [int(x) for x in lengths]
    return LocalSearch(best_fit(lengths, capacity), lengths, capacity, steps).run()


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
    reopen_below: float = REOPEN_BELOW,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    Pieces are written to the shared folder and dealt evenly, whatever their key, into groups of
    about ``group_pieces``; a task packs one. Sequences that stay underfull are opened and packed
    again with those of other groups, until one group is left or opening more gains nothing.
    Piece lengths lie between 1 and ``capacity``.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    columns = pieces.columns
    root = scratch_path(spark, "packing")
    pieces.write.parquet(f"{root}/pieces")
    waiting = spark.read.parquet(f"{root}/pieces")
    whole = waiting.where(F.col("length") == capacity)
    settled = [
        whole.withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    ]
    waiting = waiting.where(F.col("length") < capacity)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id long, offset long, reopened boolean"
    round_number, before = 1, None
    while True:
        count = waiting.count()
        if not count:
            break
        groups = math.ceil(count / group_pieces)
        last = groups == 1 or (before is not None and count > 0.7 * before)
        packed = _pack_groups(
            waiting.select(*columns), groups, round_number, capacity,
            0.0 if last else reopen_below, schema,
        )
        path = f"{root}/round={round_number}"
        packed.write.parquet(path)
        done = spark.read.parquet(path)
        settled.append(done.where(~F.col("reopened")).drop("reopened"))
        if last:
            break
        waiting, before = done.where("reopened"), count
        round_number += 1
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


def _pack_groups(waiting, groups, round_number, capacity, reopen_below, schema):
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        group = table.column("_group")[0].as_py()
        sequence = np.zeros(len(lengths), dtype=np.int64)
        offset = np.zeros(len(lengths), dtype=np.int64)
        reopened = np.zeros(len(lengths), dtype=bool)
        for number, items in enumerate(pack(lengths, capacity)):
            held = lengths[items]
            offset[items] = np.cumsum(held) - held
            sequence[items] = number
            reopened[items] = held.sum() < reopen_below * capacity
        # Rounds, groups and bins have separate ranges of numbers.
        sequence += (round_number << 56) + (group << 24)
        release()
        out = table.drop_columns(["_group"])
        out = out.append_column("sequence_id", pa.array(sequence))
        out = out.append_column("offset", pa.array(offset))
        return out.append_column("reopened", pa.array(reopened))

    dealt = waiting.withColumn(
        "_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    )
    return dealt.groupBy("_group").applyInArrow(run, schema)


def best_fit_packing(
    documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, **names: str
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, sequence_id, offset): all documents as token
    pieces, placed gaplessly into few sequences of at most ``capacity`` tokens.

    Only documents longer than ``capacity`` are cut. Null and empty texts are one end token each;
    repeated rows are placed each; an empty table gives an empty table; other columns are not
    read. Which of several equal packings results may change with the layout of the input.
    """
    return pack_pieces(token_pieces(documents, vocabulary_path, capacity, **names), capacity)
