"""Token sequences as binary shards in a keyed random order.

A Feistel network over the smallest even number of bits that holds the number of sequences is a
keyed permutation; a slot beyond the last sequence is permuted again until it falls inside
(cycle-walking). So every sequence knows its slot from its number alone, and the reverse. A shard
is a range of slots written by one task as records of one size, so slot s is at byte
(s − first) · stride of its shard and a reader can resume anywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm.scan import mix, release, slices
from pairmill.llm.transducer import TEXT_BYTES, texts_of, transducer
from pairmill.llm.vocabulary import broadcast_vocabulary
from pairmill.session import scratch_path, ship_package

ROUNDS = 6


@dataclass(frozen=True)
class Layout:
    """Records hold ``sequence_tokens`` numbers of two bytes; shards ``shard_sequences`` records."""

    sequence_tokens: int = 256
    shard_sequences: int = 1 << 15
    end_id: int = 0
    pad_id: int = 0

    @property
    def record(self) -> np.dtype:
        return np.dtype(
            [("id", "<i8"), ("piece", "<u4"), ("length", "<u4"), ("tokens", "<u2", (self.sequence_tokens,))]
        )


class Permutation:
    """A keyed one-to-one map of 0..n−1 onto itself."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % (1 << 63))
        self.keys = mix(seeds)

    def _once(self, x: np.ndarray, keys) -> np.ndarray:
        width = np.uint64(self.half)
        left, right = x >> width, x & self.mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & self.mask)
        return (right << width) | left

    def _walk(self, x, keys) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=np.uint64), keys)
        outside = np.flatnonzero(out >= np.uint64(self.n))
        while len(outside):
            out[outside] = self._once(out[outside], keys)
            outside = outside[out[outside] >= np.uint64(self.n)]
        return out.astype(np.int64)

    def slot(self, number) -> np.ndarray:
        return self._walk(number, self.keys)

    def number(self, slot) -> np.ndarray:
        # The halves are swapped at the end, so the reversed keys undo the rounds.
        return self._walk(slot, self.keys[::-1])


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path
    )


def write_training_order(
    documents: DataFrame, vocabulary_path: str, output: str, key: int = 0,
    layout: Layout | None = None, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Writes all documents as shards below ``output``; returns (shard, path, first_slot, records).

    A document is its tokens and ``end_id``, cut into sequences; the last one is padded. Null and
    empty texts are one sequence of ``end_id``; repeated rows are sequences of their own; an empty
    table gives no shard; other columns are not read. Ids are integers. Sequences are numbered by
    input partition, in two passes over the same scan; the second stops if its numbers differ from
    the first. A task writes each shard under a name of its own and renames it when complete, so a
    repeated task replaces nothing half-written.
    """
    layout = layout or Layout()
    spark = documents.sparkSession
    ship_package(spark)
    shared = broadcast_vocabulary(spark, vocabulary_path)
    size, record = layout.sequence_tokens, layout.record
    source = documents.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")
    )

    def count(batches):
        machine, total = transducer(shared.value), 0
        for batch in batches:
            for part in slices(batch.column(1), TEXT_BYTES, tidy=False):
                total += int((-(-(machine.count(texts_of(part)) + 1) // size)).sum())
        release()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64())],
            names=["part", "n"],
        )

    # One row per partition of the input.
    counted = dict(map(tuple, source.mapInArrow(count, "part int, n long").collect()))
    numbers = np.zeros(max(counted, default=-1) + 2, dtype=np.int64)
    for part, n in counted.items():
        numbers[part + 1] = n
    numbers = np.cumsum(numbers)
    total = int(numbers[-1])
    begins = spark.sparkContext.broadcast(numbers)
    order = Permutation(total, key)

    def encode(batches):
        machine = transducer(shared.value)
        end = np.array([layout.end_id], dtype=np.int32)
        number, last = begins.value[TaskContext.get().partitionId() :][:2]
        for batch in batches:
            for part in slices(batch.column(1), TEXT_BYTES, tidy=False):
                rows, pieces, contents = [], [], []
                for row, ids in enumerate(machine.encode(texts_of(part)), part.first):
                    ids = np.concatenate([ids, end])
                    if ids.max() > 0xFFFF:
                        raise ValueError("token numbers need more than two bytes")
                    ids = ids.astype("<u2")
                    for piece, start in enumerate(range(0, len(ids), size)):
                        rows.append(row)
                        pieces.append(piece)
                        contents.append(ids[start : start + size].tobytes())
                slots = order.slot(np.arange(number, number + len(rows)))
                number += len(rows)
                if number > last:
                    raise RuntimeError("the input changed between two passes")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slots // layout.shard_sequences), pa.array(slots),
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(pieces, pa.int32()), pa.array(contents, pa.binary()),
                    ],
                    names=["shard", "slot", "id", "piece", "tokens"],
                )
        release()
        if number != last:
            raise RuntimeError("the input changed between two passes")

    def write(batches) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(output)
        system.create_dir(root, recursive=True)
        shard, stream, name, held = None, None, None, 0

        def close():
            stream.close()
            path = f"{root}/shard-{shard:08d}.bin"
            system.move(name, path)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()), pa.array([f"{output}/shard-{shard:08d}.bin"]),
                    pa.array([shard * layout.shard_sequences], pa.int64()), pa.array([held], pa.int64()),
                ],
                names=["shard", "path", "first_slot", "records"],
            )

        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b <= a:
                    continue
                if shard is None or shards[a] != shard:
                    if stream is not None:
                        yield close()
                    shard, held = int(shards[a]), 0
                    name = f"{root}/.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(name)
                part = batch.slice(a, b - a)
                block = np.zeros(b - a, dtype=record)
                block["id"] = part.column(2).fill_null(-1).to_numpy()
                block["piece"] = part.column(3).to_numpy()
                block["tokens"] = layout.pad_id
                for i, content in enumerate(part.column(4).to_pylist()):
                    ids = np.frombuffer(content, "<u2")
                    block["length"][i] = len(ids)
                    block["tokens"][i, : len(ids)] = ids
                stream.write(block.tobytes())
                held += b - a
        if stream is not None:
            yield close()

    shards = -(-total // layout.shard_sequences)
    dealt = source.mapInArrow(encode, "shard long, slot long, id long, piece int, tokens binary")
    # Slots are spread evenly, so every shard has the same size and needs no sampling to range.
    ranged = dealt.repartition(max(1, shards), "shard").sortWithinPartitions("slot")
    listed = ranged.mapInArrow(write, "shard long, path string, first_slot long, records long")
    manifest = f"{output}-manifest"
    listed.write.parquet(manifest)
    return spark.read.parquet(manifest)


def read_sequences(
    spark: SparkSession, manifest: DataFrame, layout: Layout | None = None, from_slot: int = 0
) -> DataFrame:
    """(slot, id, piece, length, shard, offset, tokens) in the shards, from ``from_slot`` on.

    Each shard is read front to back in bounded blocks from the first wanted record.
    """
    layout = layout or Layout()
    record = layout.record
    block = max(1, (4 << 20) // record.itemsize)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _file_system(row["path"])
                skipped = max(0, from_slot - row["first_slot"])
                with system.open_input_file(path) as file:
                    for first in range(skipped, row["records"], block):
                        n = min(block, row["records"] - first)
                        found = np.frombuffer(
                            file.read_at(n * record.itemsize, first * record.itemsize), record
                        )
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(row["first_slot"] + first + np.arange(n)),
                                pa.array(found["id"]), pa.array(found["piece"].astype(np.int32)),
                                pa.array(found["length"].astype(np.int64)),
                                pa.array(np.full(n, row["shard"])),
                                pa.array((first + np.arange(n)) * record.itemsize),
                                pa.array(
                                    [t[:k].tobytes() for t, k in zip(found["tokens"], found["length"])],
                                    pa.binary(),
                                ),
                            ],
                            names=["slot", "id", "piece", "length", "shard", "offset", "tokens"],
                        )

    wanted = manifest.where(F.col("first_slot") + F.col("records") > from_slot)
    # A row of the list stands for a whole shard, so its few bytes are not put into one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(tasks, "shard").mapInArrow(
        run,
        "slot long, id long, piece int, length long, shard long, offset long, tokens binary",
    )


def training_order(
    documents: DataFrame, vocabulary_path: str, key: int = 0, layout: Layout | None = None
) -> DataFrame:
    """Writes the shards to the shared folder and lists every record as read back from them:
    (doc_id, piece, slot, shard, offset, length, tokens_crc32)."""
    spark = documents.sparkSession
    output = scratch_path(spark, "shards")
    manifest = write_training_order(documents, vocabulary_path, output, key, layout)
    read = read_sequences(spark, manifest, layout)
    return read.select(
        F.col("id").alias("doc_id"), "piece", "slot", "shard", "offset", "length",
        F.crc32("tokens").alias("tokens_crc32"),
    )
