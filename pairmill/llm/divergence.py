"""How the term frequencies of the sources of a language differ, in exact integers.

1. Tasks count terms. ``bytes.translate`` lowers A-Z and blanks every separator in one pass,
   ``bytes.split`` gives the terms and a ``Counter`` per document their numbers. Counters are added
   up per language and source until a bounded number of entries is held.
2. Spark adds the sparse counts of (language, term, source), and a language keeps the terms that
   stand in enough of its documents.
3. A group, which is one source of one language, gives a term the share
   ``1 + floor(scale * (count + 1) / (total + kept terms))``; so does the language as a whole. The
   divergence of p from q is ``floor((p - q)^2 / q)`` per term.
4. Part ``term`` has the terms that a group uses more than its language does. Part ``pair`` sums
   the divergence from each other source over all kept terms. Terms that neither source has all
   weigh the same, so only counts that occur are looked at: a term of one of the two by a histogram
   of the group's counts, a term of both by a join on the term.

Nothing is collected, and no row of the work grows with a document: a hot source is combined in the
tasks that read it.

Nulls in text, language and source count as empty. A document without terms makes its group occur
and nothing else. A repeated row is a document of its own. Long texts are counted piece by piece.
Without documents the result is empty; where a language keeps no term its pairs have the value 0.
Equal values rank by the item's UTF-8 bytes. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairmill.session import scratch_path

SCALE = 1_000_000_000
# Entries that a task holds before it sends them; a text is cut at separators into such pieces.
MOST_ENTRIES = 400_000
PIECE_BYTES = 1 << 20
# An entry counts documents above this bit and occurrences below it.
DOCUMENT = 1 << 44

# What a byte of a term becomes: letters of either case and all bytes beyond ASCII stay.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTED = "lang string, source string, term string, n long, docs long"


def pieces(text: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """A translated text cut at spaces; a term longer than a piece stays whole."""
    start = 0
    while len(text) - start > most:
        cut = text.rfind(b" ", start, start + most)
        if cut < 0:
            cut = text.find(b" ", start + most)
            if cut < 0:
                break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of one document."""
    counts: Counter = Counter()
    for piece in pieces(text.translate(TERM_BYTES)):
        counts.update(piece.split())
    return counts


def _sent(totals: dict) -> pa.RecordBatch:
    sizes = [len(counts) for counts in totals.values()]
    terms = [term for counts in totals.values() for term in counts]
    both = np.fromiter((n for c in totals.values() for n in c.values()), np.int64, len(terms))
    groups = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang for lang, _ in totals], pa.string()).take(groups),
            pa.array([source for _, source in totals], pa.string()).take(groups),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array(both & (DOCUMENT - 1)), pa.array(both >> 44),
        ],
        ["lang", "source", "term", "n", "docs"],
    )


def count_terms(batches: Iterator[pa.RecordBatch], most: int = MOST_ENTRIES) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to occurrences of each term and documents that have it."""
    totals: dict = defaultdict(dict)
    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            total = totals[lang, source]
            held -= len(total)
            known = total.get
            for term, n in term_counts(text.as_buffer().to_pybytes()).items():
                total[term] = known(term, 0) + n + DOCUMENT
            held += len(total)
            if held > most:
                yield _sent(totals)
                totals.clear()
                held = 0
    if held:
        yield _sent(totals)


def share(count: Column, total: Column, kept: Column, scale: int = SCALE) -> Column:
    """``1 + floor(scale * (count + 1) / (total + kept))``, in decimals where longs would end."""
    over = F.lit(scale).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", over, (total + kept).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(documents: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term, source, n, lang_n, lead) of the terms that a language keeps.

    ``lead`` is 1 on one row of each term of a language.
    """
    counted = documents.mapInArrow(count_terms, COUNTED)
    summed = counted.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    inside = Window.partitionBy("lang", "term")
    return (
        summed.withColumn("lang_docs", F.sum("docs").over(inside))
        .withColumn("lang_n", F.sum("n").over(inside))
        .withColumn("lead", (F.row_number().over(inside.orderBy("source")) == 1).cast("long"))
        .where(F.col("lang_docs") >= least_documents)
        .select("lang", "term", "source", "n", "lang_n", "lead")
    )


def source_divergence(
    documents: DataFrame, least_documents: int = 3, top_terms: int = 200, scale: int = SCALE,
    text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module for both parts."""
    spark = documents.sparkSession
    rows = documents.select(
        *[
            F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
            for column, name in (
                (lang_column, "lang"), (source_column, "source"), (text_column, "text"))
        ]
    )
    root = scratch_path(spark, "divergence")
    kept_terms(rows, least_documents).write.parquet(f"{root}/terms")
    kept = spark.read.parquet(f"{root}/terms")

    langs = kept.groupBy("lang").agg(F.sum("lead").alias("kept"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    (
        rows.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .fillna(0, ["total", "kept", "lang_total"])
        .withColumn("absent", F.when(
            F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept"), scale)))
        .write.parquet(f"{root}/groups")
    )
    groups = spark.read.parquet(f"{root}/groups")

    shares = kept.join(groups, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("kept"), scale)
    )
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), scale)
    terms = (
        shares.withColumn("q", q).where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                divergence(F.col("p"), F.col("q")).alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)
    pairs = _pairs(shares, groups).withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of every group from each other source of its language."""
    names = ["lang", "source", "item", "value"]
    own = groups.select("lang", "source", "kept", "absent")
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other"))
    nothing = divergence(F.col("absent"), F.col("other"))
    # As if no term occurred in either.
    base = own.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.coalesce(F.col("kept") * nothing, F.lit(0)).alias("value")
    )
    # What a term of one of them changes, whether that is the first or the second of a pair.
    histogram = shares.groupBy("lang", "source", "absent", "p").agg(F.count("*").alias("terms"))
    beside = histogram.join(other, "lang").where("source <> item")
    back = divergence(F.col("other"), F.col("absent"))
    one = beside.select(
        "lang",
        F.inline(F.array(
            F.struct(
                "source", "item",
                (F.col("terms") * (divergence(F.col("p"), F.col("other")) - nothing))
                .alias("value")),
            F.struct(
                F.col("item").alias("source"), F.col("source").alias("item"),
                (F.col("terms") * (divergence(F.col("other"), F.col("p")) - back))
                .alias("value")),
        )),
    )
    # What a term of both changes beyond that.
    left = shares.select("lang", "term", "source", "absent", "p")
    right = shares.select(
        "lang", "term", F.col("source").alias("item"), F.col("absent").alias("other"),
        F.col("p").alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    both = left.join(right, ["lang", "term"]).where("source <> item").select(
        "lang", "source", "item",
        (divergence(p, q) - divergence(p, F.col("other")) - divergence(F.col("absent"), q)
         + nothing).alias("value"),
    )
    parts = base.select(names).unionByName(one.select(names)).unionByName(both.select(names))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )
