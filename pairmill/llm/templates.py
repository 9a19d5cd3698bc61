"""Benchmark decontamination by templates: finds items also where their parameters were changed."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.scan import (
    BYTE_POWERS, BYTE_VALUE, LOWER, WORD_POWERS, Slice, slices, span_hashes, window_hashes,
)
from pairmill.session import scratch_path, ship_package

LITERAL, NUMBER, NAME, UNIT = range(4)
# Benchmark windows up to this number are sent to all tasks (8 bytes each) and only hits go on;
# beyond it all windows of the documents take part in the join.
BROADCAST_WINDOWS = 2_000_000

# Units that count as such behind a number.
UNITS = """
% a acre acres am amp amps bar bit bits byte bytes c cal calories cent centimeter centimeters
centimetre centimetres cents cl cm cm2 cm3 cup cups day days deg degree degrees dl dm dollar
dollars dozen dozens euro euros f feet foot ft g gallon gallons gb gram grams h ha hectare hectares
hour hours hr hrs hz in inch inches j jour jours joule joules k kb kcal kg kg/m3 khz kilo kilogram
kilograms kilometer kilometers kilometre kilometres kilos kj km km/h km2 kmh kph kw kwh l lb lbs
liter liters litre litres lumen m m/s m2 m3 mb meter meters metre metres mg mhz mi mile miles
milligram milligrams milliliter milliliters millimeter millimeters min mins minute minutes ml mm
mol moles month months mph ms n newton newtons ohm ohms oz ounce ounces pa percent pint pints pm
pound pounds quart quarts s sec second seconds stunde stunden t tb ton tonne tonnes tons v volt
volts w watt watts week weeks yard yards yd year years
""".split()

ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
STOP = np.zeros(256, dtype=bool)
STOP[list(b".!?:")] = True


@dataclass(frozen=True)
class TemplateSettings:
    """``window`` words make a window; ``least_literal`` of them must be words, not placeholders.

    A window with fewer is lengthened to ``longest`` words at most until it has them; as it is, it
    meets equal words alone. A document holds an item when windows with consistent slots cover
    ``min_coverage`` of it.
    """

    window: int = 8
    least_literal: int = 4
    min_coverage: float = 0.25
    longest: int = 32


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(span_hashes(BYTE_VALUE[data], ends - [len(u) for u in UNITS], ends, BYTE_POWERS))


UNIT_HASHES = _unit_hashes()


class Template:
    """The words of a slice of texts with numbers, names and units replaced by placeholders."""

    def __init__(self, part: Slice):
        starts, ends, owner = part.words()
        data = LOWER[part.data]
        solid = np.flatnonzero(ALNUM[part.data])
        # Signs around a word do not count; a word of signs alone is left out.
        first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        kept = last > first
        self.closing = part.data[ends - 1][kept] if len(ends) else np.zeros(0, np.uint8)
        whole = starts[kept]
        first, last, self.owner = first[kept], last[kept], owner[kept]
        self.starts = solid[first] if len(first) else first
        self.ends = solid[last - 1] + 1 if len(first) else last
        hashes = span_hashes(BYTE_VALUE[data], self.starts, self.ends, BYTE_POWERS)
        digits = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(DIGIT[part.data], out=digits[1:])
        breaks = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(part.data == 10, out=breaks[1:])
        n = len(hashes)
        number = (digits[self.ends] > digits[self.starts]) & DIGIT[part.data[self.starts]] if n else \
            np.zeros(0, bool)
        opens = np.ones(n, dtype=bool)
        if n:
            opens[1:] = (
                (self.owner[1:] != self.owner[:-1]) | STOP[self.closing[:-1]]
                | (breaks[whole[1:]] > breaks[whole[:-1]])
            )
        head = part.data[self.starts] if n else np.zeros(0, np.uint8)
        after = part.data[np.minimum(self.starts + 1, len(part.data) - 1)] if n else head
        upper = UPPER[head] | ((head == 0xC3) & (after >= 0x80) & (after <= 0x9E))
        shouted = UPPER[after] & (self.ends - self.starts > 1)
        behind = np.zeros(n, dtype=bool)
        behind[1:] = number[:-1] & (self.owner[1:] == self.owner[:-1])
        at = np.minimum(np.searchsorted(UNIT_HASHES, hashes), len(UNIT_HASHES) - 1)
        self.kind = np.zeros(n, dtype=np.int8)
        self.kind[upper & ~opens & ~shouted] = NAME
        self.kind[behind & (UNIT_HASHES[at] == hashes)] = UNIT
        self.kind[number] = NUMBER
        self.plain = hashes
        self.hashes = np.where(self.kind == LITERAL, hashes, self.kind.astype(np.uint64))
        self.literal = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(self.kind == LITERAL, out=self.literal[1:])
        self.part = part

    def word(self, i: int) -> str:
        return self.part.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace").lower()

    def verbatim(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows as they are, and their first words."""
        return window_hashes(self.plain, self.owner, n)

    def dense(self, first: np.ndarray, n: int, least_literal: int) -> np.ndarray:
        return self.literal[first + n] - self.literal[first] >= least_literal

    def templates(
        self, first: np.ndarray, n: int, least_literal: int, longest: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the windows with placeholders, their first words and ends.

        A window short of literals ends behind the last one it needs, if its text has that.
        """
        ends = first + n
        short = np.flatnonzero(~self.dense(first, n, least_literal))
        places = np.flatnonzero(self.kind == LITERAL)
        last = self.literal[first[short]] + least_literal - 1
        there = last < len(places)
        ends[short[~there]] = -1
        short = short[there]
        ends[short] = places[last[there]] + 1
        kept = (ends > first) & (ends - first <= max(n, longest))
        first, ends = first[kept], ends[kept]
        kept = self.owner[ends - 1] == self.owner[first]
        # Without a placeholder the window as it is says the same.
        kept &= self.literal[ends] - self.literal[first] < ends - first
        first, ends = first[kept], ends[kept]
        return span_hashes(self.hashes, first, ends, WORD_POWERS), first, ends

    def slots(self, first: int, n: int) -> list[str]:
        return [self.word(first + i) for i in np.flatnonzero(self.kind[first : first + n])]


WINDOWS = "at long, length int, hash long, dense boolean, slots array<string>"


def _windows(rows: DataFrame, settings: TemplateSettings, lengths=None, wanted=None) -> DataFrame:
    """(_id, at, length, hash, dense, slots) of the windows of a table (_id, _text).

    Every window comes as it is, without slots, and where it has placeholders and enough literals
    also as a template; ``dense`` ones have those without being lengthened.
    With ``lengths`` None a text shorter than the window is one window of its own length.
    ``wanted`` is a broadcast of sorted hashes that alone are of interest.
    """
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(1)):
                template = Template(part)
                counts = part.per_text(template.owner)
                begins = np.cumsum(counts) - counts
                sizes = lengths or sorted({settings.window, *counts[
                    (counts >= settings.least_literal) & (counts < settings.window)].tolist()})
                out = [[], [], [], [], [], []]
                for n in sizes:
                    found, first = template.verbatim(n)
                    if lengths is None and n < settings.window:
                        own = counts[template.owner[first]] == n
                        found, first = found[own], first[own]
                    longest = settings.longest if n == settings.window else n
                    for plain, found, first, ends in (
                        (True, found, first, first + n),
                        (False, *template.templates(first, n, settings.least_literal, longest)),
                    ):
                        if wanted is not None:
                            known = wanted.value
                            at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                            hit = known[at] == found if len(known) else np.zeros(len(found), bool)
                            found, first, ends = found[hit], first[hit], ends[hit]
                        owner = template.owner[first]
                        out[0].append(owner)
                        out[1].append(first - begins[owner])
                        out[2].append((ends - first).astype(np.int32))
                        out[3].append(found.view(np.int64))
                        out[4].append(template.dense(first, n, settings.least_literal))
                        out[5] += [
                            [] if plain else template.slots(i, e - i)
                            for i, e in zip(first.tolist(), ends.tolist())
                        ]
                if not out[0]:
                    continue
                place = pa.array(part.first + np.concatenate(out[0]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(place), *(pa.array(np.concatenate(c)) for c in out[1:5]),
                        pa.array(out[5], pa.list_(pa.string())),
                    ],
                    names=["_id", "at", "length", "hash", "dense", "slots"],
                )

    return rows.mapInArrow(run, f"_id {kind}, {WINDOWS}")


def consistent(windows: list[list[tuple[str, str]]]) -> list[bool]:
    """Which windows of one alignment count, by their pairs of an item's and a document's value."""
    pairs = {pair for window in windows for pair in window}
    # A value that the document keeps somewhere stands for itself; one with two others is torn.
    kept = {ours for ours, theirs in pairs if ours == theirs}
    new = [ours for ours, _ in pairs if ours not in kept]
    torn = len(set(new)) < len(new)
    return [
        all(ours == theirs or not (torn or ours in kept) for ours, theirs in window)
        for window in windows
    ]


def _sound(batches):
    """(_id, item, places, dense_places, changed) of alignments with windows that count."""
    for batch in batches:
        out = [[], [], [], []]
        for number, row in enumerate(batch.column("met")):
            met = row.as_py()
            windows = [[(p["ours"], p["theirs"]) for p in w["pairs"]] for w in met]
            counted = [w for w, good in zip(met, consistent(windows)) if good]
            if counted:
                out[0].append(number)
                out[1].append([w["item_at"] for w in counted])
                out[2].append([w["item_at"] for w in counted if w["item_dense"]])
                out[3].append(any(ours != theirs for window in windows for ours, theirs in window))
        place = pa.array(out[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id").take(place), batch.column("item").take(place),
                *(pa.array(c, pa.list_(pa.int64())) for c in out[1:3]), pa.array(out[3], pa.bool_()),
            ],
            names=["_id", "item", "places", "dense_places", "changed"],
        )


def contaminated(
    documents: DataFrame, benchmark: DataFrame, settings: TemplateSettings | None = None,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Rows (id, item, windows, item_windows, coverage, reparameterised), one per document and item
    that it holds; clean documents have no row.

    Words are compared without case and without signs around them. Numbers, capitalised words
    inside a sentence, and units behind a number become typed placeholders. Windows of both sides
    are hash-joined; the windows of one alignment of item and document must replace every slot
    value of the item by one value. Of a value that is kept in one place and replaced in another the
    windows that keep it count; if one is replaced by two others, the alignment's windows that
    replace anything do not count. Windows that replace nothing always count. ``reparameterised``
    tells that some value differs. Every window of an item is also looked for word by word, whatever it is made
    of, so a copy of an item with at least ``least_literal`` words is found even if the item is
    numbers alone; changed values are found where a window has ``least_literal`` literals within
    ``longest`` words. ``coverage`` is the larger of two shares, with its ``windows`` and
    ``item_windows``: of all windows, and of those that are dense with literals.

    Null and empty texts hold nothing; an item with fewer words than ``least_literal`` is not
    looked for; repeated documents and items give the same rows once per id; empty tables give an
    empty table; other columns are not read.
    """
    settings = settings or TemplateSettings()
    spark = documents.sparkSession
    ship_package(spark)

    def source(rows, key, text):
        return rows.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))

    items = _windows(source(benchmark, item_column, item_text_column), settings)
    items = items.select(
        F.col("_id").alias("item"), F.col("at").alias("item_at"), "length", "hash",
        F.col("dense").alias("item_dense"), F.col("slots").alias("item_slots"),
    ).dropDuplicates(["item", "item_at", "length", "hash"])
    path = scratch_path(spark, "items")
    items.write.parquet(path)
    items = spark.read.schema(items.schema).parquet(path)
    totals = items.groupBy("item").agg(
        F.countDistinct("item_at").alias("all"),
        F.countDistinct(F.when(F.col("item_dense"), F.col("item_at"))).alias("dense"),
    )
    hashes = items.select("hash").distinct()
    lengths = sorted(
        {settings.window, *(r["length"] for r in items.where(
            F.col("length") < settings.window).select("length").distinct().collect())}
    )
    wanted = None
    if hashes.count() <= BROADCAST_WINDOWS:
        known = np.array([r["hash"] for r in hashes.collect()], dtype=np.int64).view(np.uint64)
        wanted = spark.sparkContext.broadcast(np.sort(known))
    found = _windows(source(documents, id_column, text_column), settings, lengths, wanted)
    side = F.broadcast(items) if wanted is not None else items
    met = found.drop("dense").join(side, ["hash", "length"])
    pairs = F.arrays_zip(F.col("item_slots").alias("ours"), F.col("slots").alias("theirs"))
    # One alignment has at most two windows per word of the item, which bounds these sets.
    aligned = met.groupBy("_id", "item", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("item_at", "item_dense", pairs.alias("pairs"))).alias("met"),
    )

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema.fields}
    sound = aligned.drop("shift").mapInArrow(
        _sound, f"_id {kinds['_id']}, item {kinds['item']}, places array<long>, "
        "dense_places array<long>, changed boolean",
    )

    def held(places: str):
        return F.size(F.array_distinct(F.flatten(F.collect_set(places)))).cast("long")

    covered = (
        sound.groupBy("_id", "item").agg(
            held("places").alias("held"), held("dense_places").alias("held_dense"),
            F.bool_or("changed").alias("reparameterised"),
        )
    )

    def share(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.struct(
            (F.col(part) / F.col(whole)).alias("coverage"), F.col(part).alias("windows"),
            F.col(whole).alias("item_windows"),
        ))

    judged = covered.join(totals, "item").withColumn(
        "best", F.greatest(share("held", "all"), share("held_dense", "dense"))
    ).select("_id", "item", "best.*", "reparameterised")
    return judged.where(F.col("coverage") >= settings.min_coverage).select(
        F.col("_id").alias(id_column), F.col("item").alias(item_column), "windows",
        "item_windows", "coverage", "reparameterised",
    )
