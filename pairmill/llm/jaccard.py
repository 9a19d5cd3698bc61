"""Similarity join of documents by the Jaccard index of their word shingles.

Exact, without a shuffle of all shingles by row and without pairs of copies:

1. Documents with equal shingle sets form a class; from here on a class is one set.
2. A set can only be linked if it shares the needed part of its shingles with other sets at all.
   Tasks send sorted hash arrays per bucket of the hash space, one entry per shingle and slice of
   texts, and only for each set's smallest shingles by hash, of which linked sets have a known
   number in common; few sets get past this.
3. Of those, small sets (up to a boundary) enumerate their subsets of the size that a link
   requires; sets meeting in a subset are linked for certain and are joined like a star.
   Larger sets scan inverted lists of their rarest shingles, as many as a partner cannot miss.
   The boundary is where both cost least, from the counts of sets by size.
4. Sets connected through lists form groups, which are compared by counting common shingles
   block against block; a block pair sends a spanning forest of its links, not the links.
5. Components of the links, and the smallest document id of each.
6. Links are counted by comparing the sets of each component in the same blocks; a block pair sends
   one count per set, weighted by the sizes of the classes that it is linked with.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.llm.components import connected_components
from pairmill.llm.scan import (
    SLICE_BYTES, WORD_POWERS, Slice, mix, release, slices, span_hashes, window_hashes, word_hashes,
)
from pairmill.llm.selection import BROADCAST_IDS
from pairmill.session import scratch_path, ship_package

# Shingles that one task of the sharing count holds; more buckets are made for more.
BUCKET_SHINGLES = 1_000_000
# Bytes of text whose shingles are sorted together before they are sent.
SORTED_BYTES = 2 << 20
# Sets that are compared at once.
BLOCK_SETS = 256
# Subsets of larger sets are never fewer than list entries.
LARGEST_SMALL_SET = 40
COLUMNS_AT_ONCE = 4096


# Percent of a set's shingles that linked sets have in common among those that are sent.
SENT_COMMON = 20


def needed(size: int, percent: int) -> int:
    """Shingles that any partner of a set of this size has in common with it."""
    return -(-percent * size // 100)


def sent_common(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles in common that are looked for among those sent, for sets that are linked.

    The first k common shingles of two linked sets x and y, by hash, are among the first
    |x| − |x∩y| + k of x and the first |y| − |x∩y| + k of y. Never falls with the size, so the smaller
    set's number holds for both.
    """
    return np.maximum(1, sizes * min(SENT_COMMON, percent) // 100)


def sent_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many of its smallest shingles a set sends."""
    return np.minimum(sizes, sizes + percent * sizes // -100 + sent_common(sizes, percent))


@cache
def overlap(a: int, b: int, percent: int) -> int:
    """Common shingles that link sets of these sizes: 100·i ≥ percent·(a + b − i)."""
    return -(-percent * (a + b) // (100 + percent))


def shingles(part: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ordered by text and hash, and the text numbers.

    A text with fewer than n words has its whole sequence as its one shingle.
    """
    hashes = word_hashes(part, lower=True)
    owner = part.words()[2]
    found, first = window_hashes(hashes, owner, n)
    owners = owner[first]
    counts = part.per_text(owner)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        begin = np.searchsorted(owner, short)
        found = np.concatenate(
            [found, span_hashes(hashes, begin, begin + counts[short], WORD_POWERS)]
        )
        owners = np.concatenate([owners, short])
    order = np.lexsort([found, owners])
    found, owners = found[order], owners[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
    return found[new], owners[new]


def set_keys(found: np.ndarray, owners: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each text's set, and its size."""
    counts = np.bincount(owners, minlength=size)
    sums = np.zeros(len(found) + 1, dtype=np.uint64)
    np.cumsum(mix(found), dtype=np.uint64, out=sums[1:])
    ends = np.cumsum(counts)
    return mix(sums[ends] - sums[ends - counts] + counts.astype(np.uint64)), counts


# 48-bit hashes travel as byte planes: sorted, the high planes compress well.


def to_planes(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :6] = planes.T
    return out.reshape(-1).view("<u8")


SENT = "bucket int, single binary, place binary, many binary, keys binary, sizes binary, local binary"


def _sent(part: Slice, n: int, percent: int, buckets: int):
    """One row per bucket: what a slice of texts tells about the smallest shingles of its sets."""
    # Hashing takes many times the bytes of a text, so it goes piece by piece.
    pairs = [(piece.first, *shingles(piece, n)) for piece in part.pieces()]
    found = np.concatenate([found for _, found, _ in pairs])
    owners = np.concatenate([owners + first for first, _, owners in pairs])
    keys, counts = set_keys(found, owners, part.size)
    # Equal sets inside the slice count once.
    _, kept = np.unique(keys, return_index=True)
    wanted = np.zeros(part.size, dtype=bool)
    wanted[kept] = True
    wanted &= counts > 0
    rank = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
    inside = wanted[owners] & (rank < sent_sizes(counts, percent)[owners])
    # The smallest hashes fill few buckets.
    found, owners = mix(found[inside]), owners[inside]
    low = found & np.uint64((1 << 48) - 1)
    bucket = ((found >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort([low, bucket])
    low, bucket, owners = low[order], bucket[order], owners[order]
    edge = np.ones(len(low) + 1, dtype=bool)
    edge[1:-1] = (low[1:] != low[:-1]) | (bucket[1:] != bucket[:-1])
    alone = edge[:-1] & edge[1:]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        here = slice(cuts[b], cuts[b + 1])
        texts, place = np.unique(owners[here], return_inverse=True)
        single = alone[here]
        yield (
            b, to_planes(low[here][single]), place[single].astype("<u2").tobytes(),
            to_planes(low[here][~single & edge[:-1][here]]), keys[texts].astype("<u8").tobytes(),
            counts[texts].astype("<u4").tobytes(),
            np.bincount(place[~single], minlength=len(texts)).astype("<u4").tobytes(),
        )


COUNTED = "range int, keys binary, sizes binary, shared binary"


def _shared(table: pa.Table, ranges: int) -> pa.Table:
    """How many of its sent shingles in a bucket each set shares with other sets, by range of keys."""
    rows = table.select(["single", "place", "many", "keys", "sizes", "local"]).to_pylist()
    keys = [np.frombuffer(r["keys"], "<u8") for r in rows]
    single = np.concatenate([from_planes(r["single"]) for r in rows])
    owner = np.concatenate(
        [k[np.frombuffer(r["place"], "<u2")] for r, k in zip(rows, keys)]
    )
    many = np.unique(np.concatenate([from_planes(r["many"]) for r in rows]))
    order = np.lexsort([owner, single])
    single, owner = single[order], owner[order]
    new = np.ones(len(single), dtype=bool)
    new[1:] = (single[1:] != single[:-1]) | (owner[1:] != owner[:-1])
    single, owner = single[new], owner[new]
    other = np.zeros(len(single), dtype=bool)
    same = single[1:] == single[:-1]
    other[1:] |= same
    other[:-1] |= same
    if len(many):
        at = np.minimum(np.searchsorted(many, single), len(many) - 1)
        other |= many[at] == single
    everyone, place = np.unique(np.concatenate(keys), return_inverse=True)
    sizes = np.zeros(len(everyone), dtype=np.uint32)
    sizes[place] = np.concatenate([np.frombuffer(r["sizes"], "<u4") for r in rows])
    local = np.zeros(len(everyone), dtype=np.uint32)
    np.maximum.at(local, place, np.concatenate([np.frombuffer(r["local"], "<u4") for r in rows]))
    local += np.bincount(
        np.searchsorted(everyone, owner[other]), minlength=len(everyone)
    ).astype(np.uint32)
    hit = local > 0
    everyone, sizes, local = everyone[hit], sizes[hit], local[hit]
    span = ((everyone >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(span, np.arange(ranges + 1))
    out = [
        (r, everyone[a:b].tobytes(), sizes[a:b].tobytes(), local[a:b].tobytes())
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a
    ]
    columns = list(zip(*out)) if out else [[], [], [], []]
    del rows, keys, single, owner, many, order, everyone, place
    release()
    return pa.table(
        [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
        names=["range", "keys", "sizes", "shared"],
    )


def _enough(table: pa.Table, percent: int) -> pa.Table:
    rows = table.to_pylist()
    keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows])
    sizes = np.concatenate([np.frombuffer(r["sizes"], "<u4") for r in rows])
    shared = np.concatenate([np.frombuffer(r["shared"], "<u4") for r in rows])
    found, first, place = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(place, shared)
    # A partner may be as small as the shingles that it must have in common.
    kept = total >= sent_common(-(-percent * sizes[first].astype(np.int64) // 100), percent)
    return pa.table([pa.array(found[kept].view(np.int64))], names=["key"])


def _mapped(rows: DataFrame, schema: str, function, most: int) -> DataFrame:
    """Applies ``function(slice, ids)`` to slices of a table (_id, _text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(1), most):
                yield from function(part, batch.column(0).slice(part.first, part.size))

    return rows.mapInArrow(run, schema)


def candidate_sets(
    source: DataFrame, classes: DataFrame, total: int | None, n: int, percent: int, root: str
) -> DataFrame | None:
    """(key, size, shingles) of the sets that share enough shingles with others to be linked.

    ``classes`` names a document of each set, ``total`` is the number of shingles in all.
    """
    spark = source.sparkSession
    if not total:
        return None
    buckets = math.ceil(total * min(100, 100 - percent + SENT_COMMON) / 100 / BUCKET_SHINGLES) + 1

    def send(part, ids):
        # Places are 16-bit numbers.
        for first in range(0, part.size, 1 << 16):
            last = min(part.size, first + (1 << 16))
            bounds = part.bounds[first : last + 1]
            piece = Slice(first, part.data[bounds[0] : bounds[-1]], bounds - bounds[0])
            rows = list(zip(*_sent(piece, n, percent, buckets)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])],
                    names=["bucket", "single", "place", "many", "keys", "sizes", "local"],
                )

    sent = _mapped(source, SENT, send, SORTED_BYTES)
    counted = sent.groupBy("bucket").applyInArrow(lambda t: _shared(t, buckets), COUNTED)
    enough = counted.groupBy("range").applyInArrow(lambda t: _enough(t, percent), "key long")
    enough.write.parquet(f"{root}/enough")
    enough = spark.read.parquet(f"{root}/enough")
    ids = classes.join(enough, "key").select(F.col("first").alias("_id"))
    if enough.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def keep(part, _):
        found, owners = shingles(part, n)
        keys, counts = set_keys(found, owners, part.size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                    pa.array(found.view(np.int64)),
                ),
            ],
            names=["key", "size", "shingles"],
        )

    sets = _mapped(
        source.join(ids, "_id", "left_semi"), "key long, size int, shingles array<long>", keep,
        SLICE_BYTES,
    )
    sets.where("size > 0").write.parquet(f"{root}/sets")
    return spark.read.parquet(f"{root}/sets")


def rare_shingles(sets: DataFrame, percent: int, root: str) -> DataFrame:
    """(shingle, key, size) of the shingles whose inverted lists a set scans.

    Sets are ordered rarest shingle first, ties by hash; a set that misses at most the allowed
    part of a partner has one of its first size − needed + 1 shingles in common with it. Shingles
    of a single set come first and have no list.
    """
    spark = sets.sparkSession
    entries = sets.select("key", "size", F.explode("shingles").alias("shingle"))
    frequent = (
        entries.groupBy("shingle").agg(F.count("*").alias("sets")).where("sets > 1")
    )
    listed = entries.join(frequent, "shingle")
    spare = F.col("size") - F.ceil(F.lit(percent) * F.col("size") / 100) + 1
    ranked = listed.groupBy("key", "size").agg(
        F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("ranked")
    )
    # What is left of the prefix after the shingles that no other set has.
    left = F.greatest(spare - (F.col("size") - F.size("ranked")), F.lit(0)).cast("int")
    chosen = ranked.where(left > 0).select(
        "key", "size", F.explode(F.slice("ranked", F.lit(1), left)).alias("entry")
    )
    chosen.select("key", "size", "entry.shingle", "entry.sets").write.parquet(f"{root}/lists")
    return spark.read.parquet(f"{root}/lists")


def subsets_of(size: int, percent: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, shingles left out) of the subsets that a set enumerates."""
    out = []
    for other in range(needed(size, percent), 100 * size // percent + 1):
        if other:
            a, b = min(size, other), max(size, other)
            common = overlap(a, b, percent)
            if common <= a:
                out.append((a, b, size - common))
    return out


def choose_boundary(sets: DataFrame, lists: DataFrame, percent: int) -> int:
    """The largest size of a small set: where subsets and list entries together are fewest.

    Reads one row per size up to ``LARGEST_SMALL_SET``.
    """
    small = F.col("size") <= LARGEST_SMALL_SET
    by_size = {r["size"]: r["n"] for r in
               sets.where(small).groupBy("size").agg(F.count("*").alias("n")).collect()}
    scanned = {r["size"]: r["n"] for r in
               lists.where(small).groupBy("size").agg(F.sum("sets").alias("n")).collect()}
    best, boundary, enumerated, saved = 0, 0, 0, 0
    for size in range(1, LARGEST_SMALL_SET + 1):
        each = sum(math.comb(size, left) for _, _, left in subsets_of(size, percent))
        enumerated += by_size.get(size, 0) * each
        saved += scanned.get(size, 0)
        if enumerated - saved <= best:
            best, boundary = enumerated - saved, size
    return boundary


def subset_links(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links (a, b) among sets of at most ``boundary`` shingles, as stars."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            meet, keys, own = [], [], []
            for key, values in zip(rows["key"], rows["shingles"]):
                spread = mix(np.array(values, dtype=np.int64).view(np.uint64))
                total, size = int(spread.sum(dtype=np.uint64)), len(values)
                spread = spread.tolist()
                for a, b, left in subsets_of(size, percent):
                    if b > boundary:
                        continue
                    for out in combinations(spread, left):
                        rest = (total - sum(out)) & 0xFFFFFFFFFFFFFFFF
                        meet.append((rest * 64 + a) * 64 + b & 0xFFFFFFFFFFFFFFFF)
                        keys.append(key)
                        own.append(size == a)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mix(np.array(meet, dtype=np.uint64)).view(np.int64)),
                    pa.array(keys, pa.int64()), pa.array(own, pa.bool_()),
                ],
                names=["meet", "key", "smaller"],
            )

    small = sets.where(F.col("size") <= boundary).select("key", "shingles")
    met = small.mapInArrow(run, "meet long, key long, smaller boolean")
    # Sets of the smaller size in one subset are linked with all sets in it.
    centre = met.groupBy("meet").agg(
        F.min(F.when(F.col("smaller"), F.col("key"))).alias("centre"), F.count("*").alias("n")
    ).where("n > 1 AND centre IS NOT NULL")
    return (
        met.join(centre, "meet").where("key <> centre")
        .select(F.col("centre").alias("a"), F.col("key").alias("b")).distinct()
    )


def _forest(size: int, pairs) -> list[int]:
    root = list(range(size))
    for x, y in pairs:
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        root[max(x, y)] = min(x, y)
    for x in range(size):
        root[x] = root[root[x]]
    return root


def compare_blocks(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of one block are linked with which of the other."""
    a = np.concatenate(left)
    b = np.concatenate(right)
    common = np.intersect1d(np.unique(a), np.unique(b))
    sizes_a, sizes_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    if len(common):
        sides = []
        for values, sizes in ((a, sizes_a), (b, sizes_b)):
            at = np.minimum(np.searchsorted(common, values), len(common) - 1)
            hit = common[at] == values
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            column = at[hit]
            order = np.argsort(column, kind="stable")
            sides.append((row[order], column[order], len(sizes)))
        for first in range(0, len(common), COLUMNS_AT_ONCE):
            grids = []
            for row, column, n in sides:
                x, y = np.searchsorted(column, [first, first + COLUMNS_AT_ONCE])
                grid = np.zeros((n, min(COLUMNS_AT_ONCE, len(common) - first)), dtype=np.float32)
                grid[row[x:y], column[x:y] - first] = 1
                grids.append(grid)
            counts += grids[0] @ grids[1].T
    same = np.rint(counts).astype(np.int64)
    return 100 * same >= percent * (sizes_a[:, None] + sizes_b[None, :] - same)


def shingle_arrays(table: pa.Table) -> list[np.ndarray]:
    column = table.column("shingles").combine_chunks()
    values = column.values.to_numpy()
    bounds = column.offsets.to_numpy()
    return [values[x:y] for x, y in zip(bounds[:-1], bounds[1:])]


def block_pairs(placed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets of the groups that fit one block, and those of larger ones once per pair of blocks.

    ``placed`` has component, n (its sets), key, size, shingles and other columns to send along.
    Larger groups go in blocks of like sizes.
    """
    few = placed.where(F.col("n") <= BLOCK_SETS)
    many = placed.where(F.col("n") > BLOCK_SETS)
    dealt = _numbered(many.select("component", "key", "size"), BLOCK_SETS)
    extent = dealt.groupBy("component", "block").agg(
        F.min("size").alias("low"), F.max("size").alias("high")
    )
    x, y = extent.alias("x"), extent.alias("y")
    pairs = x.join(y, F.col("x.component") == F.col("y.component")).where(
        (F.col("x.block") <= F.col("y.block"))
        & (F.col("x.high") * 100 >= F.col("y.low") * percent)
    ).select(
        F.col("x.component").alias("component"), F.col("x.block").alias("left"),
        F.col("y.block").alias("right"),
    )
    sides = pairs.select("component", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    sent = (
        sides.join(dealt.select("component", "block", "key"), ["component", "block"])
        .join(many.drop("component", "n", "size"), "key")
    )
    return few, sent


def list_links(sets: DataFrame, lists: DataFrame, boundary: int, percent: int, root: str) -> DataFrame:
    """Links (a, b) of sets above the boundary with any other set, as forests."""
    spark = sets.sparkSession
    least = needed(boundary + 1, percent)
    scanned = lists.where(F.col("size") >= least)
    # Only lists with a large set matter.
    centre = scanned.groupBy("shingle").agg(
        F.min("key").alias("centre"), F.max("size").alias("largest"), F.count("*").alias("n")
    ).where((F.col("n") > 1) & (F.col("largest") > boundary))
    edges = (
        scanned.join(centre, "shingle").where("key <> centre")
        .select(F.col("key").alias("a"), F.col("centre").alias("b"))
    )
    groups = connected_components(edges)
    counted = groups.groupBy("component").agg(F.count("*").alias("n"))
    placed = groups.join(counted, "component").withColumnRenamed("node", "key")
    placed = placed.join(sets.dropDuplicates(["key"]), "key")
    placed.write.parquet(f"{root}/groups")
    placed = spark.read.parquet(f"{root}/groups")

    def stars(keys: list[int], pairs) -> pa.Table:
        forest = _forest(len(keys), pairs)
        found = [(keys[r], keys[i]) for i, r in enumerate(forest) if r != i]
        return pa.table(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
            names=["a", "b"],
        )

    def whole(table: pa.Table) -> pa.Table:
        own = shingle_arrays(table)
        linked = compare_blocks(own, own, percent)
        return stars(table.column("key").to_pylist(), np.argwhere(np.triu(linked, 1)).tolist())

    few, sent = block_pairs(placed, percent)
    few = few.groupBy("component").applyInArrow(whole, "a long, b long")

    def between(table: pa.Table) -> pa.Table:
        blocks = np.array(table.column("block").to_pylist())
        left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
        own, keys = shingle_arrays(table), table.column("key").to_pylist()
        p, q = np.flatnonzero(blocks == left), np.flatnonzero(blocks == right)
        linked = compare_blocks([own[i] for i in p], [own[i] for i in q], percent)
        found = np.argwhere(linked)
        return stars(keys, zip(p[found[:, 0]].tolist(), q[found[:, 1]].tolist()))

    more = sent.groupBy("component", "left", "right").applyInArrow(between, "a long, b long")
    return few.unionByName(more)


def link_counts(sets: DataFrame, named: DataFrame, percent: int, root: str) -> DataFrame:
    """(key, links): how many documents of other classes each class is linked with.

    ``named`` has the component and the number of documents (held) of each linked class.
    """
    spark = sets.sparkSession
    counted = named.groupBy("component").agg(F.count("*").alias("n"))
    placed = named.join(counted, "component").join(sets.dropDuplicates(["key"]), "key")
    placed.write.parquet(f"{root}/linked")
    placed = spark.read.parquet(f"{root}/linked")

    def counts(keys: np.ndarray, linked: np.ndarray, held: np.ndarray) -> pa.Table:
        links = linked.astype(np.float64) @ held
        hit = links > 0
        return pa.table([pa.array(keys[hit]), pa.array(links[hit].astype(np.int64))], names=["key", "links"])

    def columns(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        return shingle_arrays(table), table.column("key").to_numpy(), table.column("held").to_numpy()

    def whole(table: pa.Table) -> pa.Table:
        own, keys, held = columns(table)
        linked = compare_blocks(own, own, percent)
        np.fill_diagonal(linked, False)
        return counts(keys, linked, held)

    def between(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
        if left == right:
            return whole(table)
        own, keys, held = columns(table)
        p, q = np.flatnonzero(blocks == left), np.flatnonzero(blocks == right)
        linked = compare_blocks([own[i] for i in p], [own[i] for i in q], percent)
        return pa.concat_tables(
            [counts(keys[p], linked, held[q]), counts(keys[q], linked.T, held[p])]
        )

    few, sent = block_pairs(placed, percent)
    found = few.groupBy("component").applyInArrow(whole, "key long, links long").unionByName(
        sent.groupBy("component", "left", "right").applyInArrow(between, "key long, links long")
    )
    return found.groupBy("key").agg(F.sum("links").alias("links"))


def _numbered(rows: DataFrame, most: int) -> DataFrame:
    """Deals the rows of each component into blocks of at most ``most``, ordered by size.

    Sets of one size and hash range are numbered in separate tasks, shifted by the counts of
    those before, so no task sees a whole component.
    """
    cells = rows.withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(64)))
    counts = cells.groupBy("component", "size", "cell").agg(F.count("*").alias("held"))
    before = Window.partitionBy("component").orderBy("size", "cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifted = counts.withColumn("shift", F.coalesce(F.sum("held").over(before), F.lit(0)))
    inside = Window.partitionBy("component", "size", "cell").orderBy("key")
    numbered = cells.withColumn("place", F.row_number().over(inside) - 1).join(
        shifted.drop("held"), ["component", "size", "cell"]
    )
    return numbered.select(
        "component", "key", "size",
        F.floor((F.col("shift") + F.col("place")) / most).cast("int").alias("block"),
    )


def jaccard_components(
    documents: DataFrame, n: int = 3, percent: int = 90, id_column: str = "doc_id",
    text_column: str = "text", count_links: bool = True,
) -> DataFrame:
    """Rows (id, n_shingles, component_id, n_links), one per document; n_links on request.

    Words are runs without white space, A-Z lower-cased. Two documents are linked when the
    Jaccard index of their sets of n-word shingles is at least ``percent``/100; component_id is
    the smallest id that links reach, n_links the number of other rows linked with it. A document without words (null text too) is linked with
    nothing and is its own component. Repeated rows are linked with each other; an empty table
    gives an empty table; other columns are not read. Shingles and sets are told apart by 64-bit
    hashes.
    """
    spark = documents.sparkSession
    ship_package(spark)
    root = scratch_path(spark, "jaccard")
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    kind = source.schema["_id"].dataType.simpleString()

    def describe(part, ids):
        keys, counts = set_keys(*shingles(part, n), part.size)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
            names=["_id", "key", "size"],
        )

    _mapped(source, f"_id {kind}, key long, size long", describe, SLICE_BYTES).write.parquet(
        f"{root}/members"
    )
    members = spark.read.parquet(f"{root}/members")
    filled = members.where("size > 0")
    # One row per set from here on, whatever a class holds. Written, so that a join with all
    # members is a plain one whose hot keys Spark can split.
    filled.groupBy("key").agg(
        F.min("_id").alias("first"), F.count("*").alias("held")
    ).write.parquet(f"{root}/classes")
    classes = spark.read.parquet(f"{root}/classes")
    total = filled.agg(F.sum("size")).first()[0]
    sets = candidate_sets(source, classes, total, n, percent, root)
    if sets is not None:
        lists = rare_shingles(sets, percent, root)
        boundary = choose_boundary(sets, lists, percent)
        links = list_links(sets, lists, boundary, percent, root)
        if boundary:
            links = links.unionByName(subset_links(sets, boundary, percent))
        links.write.parquet(f"{root}/links")
        found = connected_components(spark.read.parquet(f"{root}/links"))
        named = found.withColumnRenamed("node", "key").join(classes, "key")
        least = named.groupBy("component").agg(F.min("first").alias("least"))
        linked = named.join(least, "component").select("key", "least")
        rows = classes.join(linked, "key", "left")
        if count_links:
            counted = link_counts(sets, named.select("component", "key", "held"), percent, root)
            rows = rows.join(counted, "key", "left")
        else:
            rows = rows.withColumn("links", F.lit(None).cast("long"))
        rows.select(
            "key", F.coalesce("least", "first").alias("component_id"),
            (F.col("held") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
        ).write.parquet(f"{root}/named")
        classes = spark.read.parquet(f"{root}/named")
    else:
        classes = classes.select(
            "key", F.col("first").alias("component_id"), (F.col("held") - 1).alias("_links")
        )
    placed = members.join(
        classes.withColumnRenamed("component_id", "_component"),
        (members["key"] == classes["key"]) & (members["size"] > 0), "left",
    )
    out = placed.select(
        F.col("_id").alias(id_column), F.col("size").alias("n_shingles"),
        F.coalesce("_component", "_id").alias("component_id"),
        F.coalesce("_links", F.lit(0)).alias("n_links"),
    )
    return out if count_links else out.drop("n_links")
