"""Byte-pair encoding by sets: every distinct word is merged once, with joins and nothing else.

A word is a row of symbols, at first its bytes. Each round joins the pairs of neighbouring symbols with the
table of merges, takes the best rank per word and merges that pair wherever it stands in the word, from left to
right. Words without such a pair are done. The merge table is as large as the vocabulary, whatever the data, and
is broadcast; words are shuffled once per few rounds, and only those that are not done. No Python worker
and no tokenizer library takes part.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.session import scratch_path
from pairmill.sources import files

# Fixed value: how byte-level vocabularies of this kind cut a text into words.
WORDS = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Rounds between two writes; a plan of very many rounds takes longer to plan than to run.
ROUNDS = 4


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary: itself where it is printable, others
    follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class BytePairs:
    """``merges``: (left, right, rank), ``ids``: (symbol, id); symbols are hex digits of bytes."""

    merges: DataFrame
    ids: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> BytePairs:
        """From the tokenizer file of a byte-level vocabulary without a normalizer."""
        spec = json.loads(files.read_text(spark, path))
        model, cut = spec["model"], spec["pre_tokenizer"]
        known = (
            model["type"] == "BPE" and spec["normalizer"] is None and cut["type"] == "ByteLevel"
            and not cut["add_prefix_space"] and cut.get("use_regex", True)
        )
        if not known:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        byte_of = byte_characters()

        def symbol(token: str) -> str:
            return "".join(f"{byte_of[c]:02X}" for c in token)

        merges = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            merges.append((symbol(left), symbol(right), rank))
        ids = [(symbol(t), i) for t, i in model["vocab"].items() if all(c in byte_of for c in t)]
        return cls(
            spark.createDataFrame(merges, "left string, right string, rank int"),
            spark.createDataFrame(ids, "symbol string, id bigint"),
        )


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def _symbols(word: Column) -> Column:
    """Every byte between bars: |61||62|."""
    return F.regexp_replace(F.hex(F.encode(word, "UTF-8")), "(..)", r"\|$1\|")


def _parts() -> Column:
    return F.split(F.expr("substring(symbols, 2, length(symbols) - 2)"), r"\|\|")


def _round(state: DataFrame, merges: DataFrame) -> DataFrame:
    """Merges the best pair of every word; ``open`` says whether it had one."""
    neighbours = F.expr(
        "transform(sequence(1, size(parts) - 1), i -> struct(parts[i - 1] AS left, parts[i] AS right))"
    )
    pairs = state.withColumn("parts", _parts()).select(
        "word", "symbols",
        F.explode_outer(F.when(F.size("parts") > 1, neighbours)).alias("pair"),
    )
    ranked = pairs.join(
        F.broadcast(merges), (F.col("pair.left") == F.col("left")) & (F.col("pair.right") == F.col("right")),
        "left",
    )
    best = ranked.groupBy("word", "symbols").agg(F.min("rank").alias("rank"))
    merged = F.replace(
        "symbols", F.concat(F.lit("|"), "left", F.lit("||"), "right", F.lit("|")),
        F.concat(F.lit("|"), "left", "right", F.lit("|")),
    )
    return best.join(F.broadcast(merges), "rank", "left").select(
        "word", F.when(F.col("rank").isNotNull(), merged).otherwise(F.col("symbols")).alias("symbols"),
        F.col("rank").isNotNull().alias("open"),
    )


def word_ids(distinct_words: DataFrame, vocabulary: BytePairs) -> DataFrame:
    """(word, ids) of a table of distinct, not empty words.

    Takes as many rounds as the word with the most merges needs.
    """
    spark = distinct_words.sparkSession
    root = scratch_path(spark, "merges")
    state = distinct_words.select("word", _symbols(F.col("word")).alias("symbols"))
    done, step = [], 0
    while True:
        for _ in range(ROUNDS):
            state = _round(state.drop("open"), vocabulary.merges)
        path = f"{root}/step={step}"
        state.write.partitionBy("open").parquet(path)
        written = spark.read.schema("word string, symbols string, open boolean").parquet(path)
        done.append(written.where(~F.col("open")))
        state, step = written.where("open"), step + 1
        if state.isEmpty():
            break
    merged = done[0]
    for more in done[1:]:
        merged = merged.unionByName(more)
    placed = merged.select("word", F.posexplode(_parts()).alias("pos", "symbol"))
    known = placed.join(F.broadcast(vocabulary.ids), "symbol")
    return known.groupBy("word").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id")))["id"].alias("ids")
    )


def token_ids(
    rows: DataFrame, text: str, keys: list[str], vocabulary: BytePairs
) -> DataFrame:
    """``keys`` and the token ids of each text; ``keys`` identify a row.

    Null texts have null ids, empty ones none. Strings of special tokens are text like any other. A
    word is joined once per text that has it, with all its places there, so a word that stands in every
    text is one row per text.
    """
    cut = rows.select(*keys, words(F.col(text)).alias("words"))
    placed = cut.select(*keys, F.posexplode("words").alias("pos", "word"))
    grouped = placed.groupBy(*keys, "word").agg(F.collect_list("pos").alias("places"))
    encoded = word_ids(placed.select("word").distinct(), vocabulary)
    tokens = grouped.join(encoded, "word").select(*keys, F.explode("places").alias("pos"), "ids")
    joined = tokens.groupBy(*keys).agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("pos", "ids")))["ids"]).alias("ids")
    )
    told = [F.col(f"all.{k}").eqNullSafe(F.col(f"found.{k}")) for k in keys]
    match = told[0]
    for more in told[1:]:
        match = match & more
    none = F.when(F.col("all._present"), F.array().cast("array<bigint>"))
    every = rows.select(*keys, F.col(text).isNotNull().alias("_present"))
    return every.alias("all").join(joined.alias("found"), match, "left").select(
        *[F.col(f"all.{k}") for k in keys], F.coalesce("found.ids", none).alias("ids")
    )
