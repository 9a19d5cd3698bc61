"""Interpolated modified Kneser-Ney bigram model, counted in Spark and mapped by its readers.

Counting: tasks send distinct words and bigrams as sorted arrays per bucket of the hash space; a
bucket is merged by one task, which writes its part of the model to the shared folder as plain
arrays sorted by hash. Bigrams are dealt by their first word, but those of very frequent words by
both, so no bucket depends on one word. Scoring: workers map the files into memory and look whole
batches up by binary search; nothing of the model is sent through the driver.

p(w | u) = (c(uw) − D(c)) / c(u) + λ(u) · p(w), and
p(w) = (N(·w) − D'(N)) / N(··) + λ' / (V + 1), where N counts distinct left neighbours, D and D' are
the three modified discounts of their level, λ the mass they free, and the unknown word is one of
V + 1.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.sampling import fold
from pairmill.llm.scan import Slice, mix, release, slices, word_hashes
from pairmill.llm.training_order import _file_system
from pairmill.session import scratch_path, ship_package

# Hashes of the marks around a text; words have other hashes with all but certainty.
BEGIN, END = np.uint64(0x5D1F0A9C3E7B2486), np.uint64(0xA3C8E61B94F07D52)
# Bytes of text per bucket of words and of bigrams.
WORD_BUCKET_BYTES, BIGRAM_BUCKET_BYTES = 256 << 20, 32 << 20
# Entries that a task gathers before it sends them.
GATHERED = 2_000_000
# Words with more than this share of all tokens have their bigrams dealt by both words.
FREQUENT_SHARE = 1 / 2000
MANY = 255


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash space, so buckets are in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bigram_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of the first word's hash and the upper 48 bits of the second's."""
    return mix(first * np.uint64(0x9FB21C651E98DF25) + (second >> np.uint64(16)))


def bigram_bucket(first, hashes, frequent: np.ndarray, buckets: int) -> np.ndarray:
    dealt = mix(first)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)
        dealt = np.where(frequent[at] == first, hashes, dealt)
    return bucket_of(dealt, buckets)


def tokens(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word or END, its left neighbour or BEGIN, text number) of every token, in order."""
    words, owner = word_hashes(part, lower=True), part.words()[2]
    counts = part.per_text(owner)
    ends = np.cumsum(counts + 1) - 1
    found = np.empty(len(words) + part.size, dtype=np.uint64)
    last = np.zeros(len(found), dtype=bool)
    last[ends] = True
    found[last], found[~last] = END, words
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[ends - counts] = BEGIN
    return found, before, np.repeat(np.arange(part.size), counts + 1)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else \
        np.zeros(0, np.int64)
    sums = [np.add.reduceat(v[order], first) if len(keys) else v for v in values]
    return keys[first], *sums


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int32() if isinstance(c[0], int) else pa.binary() for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=names.split()
    )


def _by_bucket(buckets: np.ndarray, most: int, *columns: np.ndarray):
    """(bucket, bytes of each column) of entries in the order of their buckets."""
    cuts = np.searchsorted(buckets, np.arange(most + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield (b, *(c[cuts[b] : cuts[b + 1]].tobytes() for c in columns))


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in table.column(column).to_pylist()])


def _save(folder: str, name: str, values: np.ndarray) -> None:
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    staged = f"{root}/.{uuid.uuid4().hex}"
    with system.open_output_stream(staged) as stream:
        stream.write(values.tobytes())
    system.move(staged, f"{root}/{name}")


def _planes(values: np.ndarray) -> bytes:
    """Upper six bytes, plane by plane."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, 2:] = planes.T
    return out.reshape(-1).view("<u8")


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from how many entries were counted once to four times."""
    if not all(n[:4]):
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in enumerate(found, 1))


@dataclass(frozen=True)
class LanguageModel:
    """Where the arrays are, and the few numbers that are global."""

    folder: str
    words: int
    bigrams: int
    frequent: tuple[int, ...]
    train_tokens: int
    vocabulary: int
    neighbours: int
    bigram_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    freed: float


WORDS = "bucket hashes counts"
PAIRS = "bucket first runs second counts"
STATS = "kind int, bucket int, keys binary, values binary"
WORD_FILES = {"hash": "<u8", "count": "<u8", "left": "<u4", "once": "<u4", "twice": "<u4", "more": "<u4"}


def fit_language_model(training: DataFrame, id_column: str, text_column: str) -> LanguageModel | None:
    """Counts all rows of ``training``; None if it has none."""
    spark = training.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "language-model")
    folder = f"{root}/arrays"
    source = training.select(F.col(text_column).cast("string").alias("_text"))
    size = source.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("_text")).alias("bytes")
    ).first()
    if not size["n"]:
        return None
    word_buckets = math.ceil(((size["bytes"] or 0) + 1) / WORD_BUCKET_BYTES)
    pair_buckets = math.ceil(((size["bytes"] or 0) + 1) / BIGRAM_BUCKET_BYTES)

    def send_words(batches):
        held, counts, n = [], [], 0

        def flush():
            keys, sums = _summed(np.concatenate(held), np.concatenate(counts))
            rows = _by_bucket(bucket_of(keys, word_buckets), word_buckets, keys, sums)
            return _batch(list(rows), WORDS)

        for batch in batches:
            for part in slices(batch.column(0)):
                keys, sums = np.unique(tokens(part)[0], return_counts=True)
                held += [keys, np.array([BEGIN])]
                counts += [sums.astype("<u8"), np.array([part.size], dtype="<u8")]
                n += len(keys)
                if n > GATHERED:
                    yield flush()
                    held, counts, n = [], [], 0
        if held:
            yield flush()

    def merge_words(table):
        keys, counts = _summed(_joined(table, "hashes", "<u8"), _joined(table, "counts", "<u8"))
        row = (table.column("bucket")[0].as_py(), keys.tobytes(), counts.tobytes())
        return pa.Table.from_batches([_batch([row], WORDS)])

    schema = "bucket int, hashes binary, counts binary"
    sent = source.mapInArrow(send_words, schema)
    sent.groupBy("bucket").applyInArrow(merge_words, schema).write.parquet(f"{root}/words")
    words = spark.read.parquet(f"{root}/words")

    def total(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                real = np.frombuffer(keys, "<u8") != BEGIN
                n = int(np.frombuffer(counts, "<u8")[real].sum())
                yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    train_tokens = words.mapInArrow(total, "n long").agg(F.sum("n")).first()[0]
    least = max(100.0, train_tokens * FREQUENT_SHARE)

    def most(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                big = np.frombuffer(counts, "<u8") > least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(keys, "<u8")[big].view(np.int64))], names=["hash"]
                )

    # At most 1 / FREQUENT_SHARE words.
    found = [r["hash"] for r in words.mapInArrow(most, "hash long").collect()]
    frequent = np.sort(np.array(found, dtype=np.int64).view(np.uint64))

    def send_pairs(batches):
        firsts, seconds, n = [], [], 0

        def flush():
            first, second = np.concatenate(firsts), np.concatenate(seconds)
            keys = bigram_hash(first, second)
            keys, at, counts = np.unique(keys, return_index=True, return_counts=True)
            first, second = first[at], second[at]
            bucket = bigram_bucket(first, keys, frequent, pair_buckets)
            order = np.lexsort([second, first, bucket])
            first, second, counts, bucket = first[order], second[order], counts[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(pair_buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                here = slice(cuts[b], cuts[b + 1])
                own, runs = np.unique(first[here], return_counts=True)
                yield _batch(
                    [(
                        b, own.tobytes(), runs.astype("<u4").tobytes(), _planes(second[here]),
                        counts[here].astype("<u4").tobytes(),
                    )],
                    PAIRS,
                )

        for batch in batches:
            for part in slices(batch.column(0)):
                second, first, _ = tokens(part)
                firsts.append(first)
                seconds.append(second)
                n += len(first)
                if n > GATHERED:
                    yield from flush()
                    firsts, seconds, n = [], [], 0
        if firsts:
            yield from flush()

    def merge_pairs(table):
        bucket = table.column("bucket")[0].as_py()
        first = np.repeat(_joined(table, "first", "<u8"), _joined(table, "runs", "<u4"))
        second = np.concatenate([_from_planes(x) for x in table.column("second").to_pylist()])
        keys = bigram_hash(first, second)
        order = np.argsort(keys, kind="stable")
        keys, first, second = keys[order], first[order], second[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(_joined(table, "counts", "<u4")[order].astype(np.int64), begin)
        keys, first, second = keys[begin], first[begin], second[begin]
        _save(folder, f"pair-{bucket}-hash", keys)
        _save(folder, f"pair-{bucket}-count", np.minimum(counts, MANY).astype(np.uint8))
        large = np.flatnonzero(counts >= MANY)
        _save(folder, f"pair-{bucket}-large", np.stack([large, counts[large]]).astype("<u8"))
        rows = [(0, 0, b"", np.bincount(np.minimum(counts, 5), minlength=6).astype("<u8").tobytes())]
        # Distinct left neighbours of every second word.
        own, left = np.unique(second, return_counts=True)
        rows += [(1, *r) for r in _by_bucket(bucket_of(own, word_buckets), word_buckets, own, left.astype("<u4"))]
        # How many right neighbours every first word has by their count.
        own, *levels = _summed(
            first, *((counts == 1).astype("<u4"), (counts == 2).astype("<u4"), (counts > 2).astype("<u4"))
        )
        levels = np.stack(levels, axis=1).astype("<u4")
        rows += [(2, *r) for r in _by_bucket(bucket_of(own, word_buckets), word_buckets, own, levels)]
        del order, keys, first, second, begin, counts
        release()
        return pa.Table.from_batches([_batch(rows, "kind bucket keys values")])

    pairs = source.mapInArrow(
        send_pairs, "bucket int, first binary, runs binary, second binary, counts binary"
    )
    pairs.groupBy("bucket").applyInArrow(merge_pairs, STATS).write.parquet(f"{root}/pairs")
    stats = spark.read.schema(STATS).parquet(f"{root}/pairs")

    def finish(table):
        bucket = table.column("bucket")[0].as_py()
        kinds = np.array(table.column("kind").to_pylist())
        part = [table.filter(pa.array(kinds == k)) for k in (1, 2, 3)]
        keys, counts = (
            _summed(_joined(part[2], "keys", "<u8"), _joined(part[2], "values", "<u8"))
            if part[2].num_rows else (np.zeros(0, "<u8"), np.zeros(0, "<u8"))
        )
        left = np.zeros(len(keys), dtype="<u4")
        levels = np.zeros((len(keys), 3), dtype="<u4")
        if part[0].num_rows:
            own, sums = _summed(_joined(part[0], "keys", "<u8"), _joined(part[0], "values", "<u4"))
            short = keys >> np.uint64(16)
            at = np.minimum(np.searchsorted(own >> np.uint64(16), short), len(own) - 1)
            left = np.where(own[at] >> np.uint64(16) == short, sums[at], 0).astype("<u4")
        if part[1].num_rows:
            own = _joined(part[1], "keys", "<u8")
            values = _joined(part[1], "values", "<u4").reshape(-1, 3)
            at = np.searchsorted(keys, own)
            np.add.at(levels, at, values)
        columns = [keys, counts, left, levels[:, 0], levels[:, 1], levels[:, 2]]
        for (name, kind), values in zip(WORD_FILES.items(), columns):
            _save(folder, f"word-{bucket}-{name}", values.astype(kind))
        real = keys != BEGIN
        seen = np.bincount(np.minimum(left[real], 5), minlength=6)
        values = np.array([real.sum(), left[real].sum(), *seen], dtype="<u8")
        return pa.Table.from_batches([_batch([(4, bucket, b"", values.tobytes())], "kind bucket keys values")])

    raw = words.select(
        F.lit(3).alias("kind"), "bucket", F.col("hashes").alias("keys"), F.col("counts").alias("values")
    )
    finished = raw.unionByName(stats.where("kind > 0")).groupBy("bucket").applyInArrow(finish, STATS)
    ends = sum(np.frombuffer(r["values"], "<u8").astype(np.int64) for r in finished.collect())
    seen = sum(
        np.frombuffer(r["values"], "<u8").astype(np.int64)
        for r in stats.where("kind = 0").select("values").collect()
    )
    vocabulary, neighbours, by_left = int(ends[0]), int(ends[1]), [int(x) for x in ends[2:]]
    lower = discounts(by_left[1:5])
    more = vocabulary - sum(by_left[:3])
    freed = (lower[0] * by_left[1] + lower[1] * by_left[2] + lower[2] * more) / neighbours
    return LanguageModel(
        folder, word_buckets, pair_buckets, tuple(frequent.tolist()), train_tokens, vocabulary,
        neighbours, discounts([int(x) for x in seen[1:5]]), lower, freed,
    )


class Reader:
    """The arrays of a model, mapped into memory when first needed."""

    def __init__(self, model: LanguageModel, folder: str):
        self.model, self.folder, self.files = model, folder, {}
        self.frequent = np.array(model.frequent, dtype=np.uint64)

    def file(self, name: str, kind) -> np.ndarray:
        if name not in self.files:
            try:
                self.files[name] = np.memmap(f"{self.folder}/{name}", dtype=kind, mode="r")
            except (FileNotFoundError, ValueError):
                # A bucket without entries.
                self.files[name] = np.zeros(0, dtype=kind)
        return self.files[name]

    def words(self, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """What is stored of sorted word hashes; 0 for unknown ones."""
        out = {n: np.zeros(len(hashes), dtype=np.int64) for n in WORD_FILES if n != "hash"}
        cuts = np.searchsorted(bucket_of(hashes, self.model.words), np.arange(self.model.words + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            known = self.file(f"word-{b}-hash", "<u8")
            if not len(known):
                continue
            own = hashes[cuts[b] : cuts[b + 1]]
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = np.flatnonzero(known[at] == own)
            for name in out:
                out[name][cuts[b] + hit] = self.file(f"word-{b}-{name}", WORD_FILES[name])[at[hit]]
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = bigram_hash(first, second)
        bucket = bigram_bucket(first, keys, self.frequent, self.model.bigrams)
        order = np.lexsort([keys, bucket])
        keys, bucket = keys[order], bucket[order]
        found = np.zeros(len(keys), dtype=np.int64)
        cuts = np.searchsorted(bucket, np.arange(self.model.bigrams + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            known = self.file(f"pair-{b}-hash", "<u8")
            if not len(known):
                continue
            own = keys[cuts[b] : cuts[b + 1]]
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = np.flatnonzero(known[at] == own)
            counts = self.file(f"pair-{b}-count", np.uint8)[at[hit]].astype(np.int64)
            large = np.flatnonzero(counts == MANY)
            if len(large):
                places, values = self.file(f"pair-{b}-large", "<u8").reshape(2, -1)
                counts[large] = values[np.searchsorted(places, at[hit[large]])]
            found[cuts[b] + hit] = counts
        out = np.empty_like(found)
        out[order] = found
        return out

    def score(self, part: Slice) -> dict[str, np.ndarray]:
        model = self.model
        second, first, owner = tokens(part)
        words, at = np.unique(np.concatenate([second, first]), return_inverse=True)
        own, before = at[: len(second)], at[len(second) :]
        known = self.words(words)
        counts = known["count"][own]
        base = np.log10((counts + 0.5) / (model.train_tokens + 0.5 * (model.vocabulary + 1)))

        def discounted(n, steps):
            return n - np.select([n == 0, n == 1, n == 2], [0.0, steps[0], steps[1]], steps[2])

        left = known["left"]
        lower = discounted(left, model.word_discounts) / model.neighbours
        lower = (lower + model.freed / (model.vocabulary + 1))[own]
        pairs = self.pairs(first, second)
        total = known["count"][before]
        d1, d2, d3 = model.bigram_discounts
        free = d1 * known["once"] + d2 * known["twice"] + d3 * known["more"]
        safe = np.maximum(total, 1)
        higher = discounted(pairs, model.bigram_discounts) / safe
        chance = np.where(total > 0, higher + free[before] / safe * lower, lower)
        return {
            "n_tokens": part.per_text(owner), "n_known": part.per_text(owner, counts > 0).astype(np.int64),
            "base_score": part.per_text(owner, base), "score": part.per_text(owner, np.log10(chance)),
        }


_readers: dict[str, Reader] = {}


def _reader(model: LanguageModel, folder: str) -> Reader:
    if folder not in _readers:
        _readers.clear()
        _readers[folder] = Reader(model, folder)
    return _readers[folder]


def score_texts(documents: DataFrame, model: LanguageModel, id_column: str, text_column: str) -> DataFrame:
    """(_id, n_tokens, n_known, base_score, score) of every row, each text whole.

    Workers map the model's files where the shared folder is mounted. Where it is another kind of
    store, Spark hands the files to every executor, also to later ones.
    """
    spark = documents.sparkSession
    ship_package(spark)
    folder = model.folder
    mounted = "://" not in folder.replace("file://", "", 1)
    if mounted:
        folder = folder.removeprefix("file://").removeprefix("file:")
    else:
        spark.sparkContext.addFile(folder, recursive=True)
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches):
        reader = _reader(model, folder if mounted else SparkFiles.get(folder.rsplit("/", 1)[1]))
        for batch in batches:
            for part in slices(batch.column(1)):
                found = reader.score(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.size),
                        *(pa.array(v) for v in found.values()),
                    ],
                    names=["_id", *found],
                )

    return source.mapInArrow(
        run, f"_id {kind}, n_tokens long, n_known long, base_score double, score double"
    )


def is_held_out(id_column: Column, folds: int, held_out: int) -> Column:
    return F.coalesce(fold(id_column, folds) == held_out, F.lit(False))


def language_model_scores(
    documents: DataFrame, folds: int = 5, held_out: int = 1, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    The model learns from all documents outside the held-out fold. Scores are log10
    probabilities of the whole text and one end. Null and empty texts are the end alone; repeated
    rows count and are scored each; rows without an id are learned from; an empty table gives an
    empty table, and where every row is held out all scores are null; other columns are not read.
    """
    training = documents.where(~is_held_out(F.col(id_column), folds, held_out))
    model = fit_language_model(training, id_column, text_column)
    if model is None:
        model = LanguageModel("", 1, 1, (), 0, 0, 1, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 1.0)
    scored = score_texts(documents, model, id_column, text_column)
    return scored.select(
        F.col("_id").alias(id_column), is_held_out(F.col("_id"), folds, held_out).alias("held_out"),
        "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
