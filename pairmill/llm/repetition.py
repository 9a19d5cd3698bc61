"""Quality rules by repetition coverage: characters inside duplicated n-grams and lines."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.scan import (
    BYTE_POWERS, BYTE_VALUE, SPACE, Slice, mix, slices, span_hashes, window_hashes, word_hashes,
)
from pairmill.session import ship_package

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = 10


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the published repetition rules, as shares of a text's word characters.

    ``ngram_share`` maps an n-gram length to the largest share of characters that may stand in
    n-grams seen earlier in the text.
    """

    min_words: int = 50
    window: int = 3
    max_repeat_words: float = 0.5
    max_dup_line_share: float = 0.2
    ngram_share: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal another one, and which equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    shared, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return shared, later


def _covered(first: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside any of the n-word windows that begin at ``first``."""
    edges = np.zeros(words + 1, dtype=np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))


def _lines(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the lines that hold a word."""
    breaks = np.flatnonzero(part.data == NEWLINE)
    starts = np.concatenate([part.bounds[:-1], breaks + 1])
    ends = np.concatenate([breaks, part.bounds[1:]])
    starts.sort()
    ends.sort()
    solid = np.zeros(len(part.data) + 1, dtype=np.int64)
    np.cumsum(~SPACE[part.data], out=solid[1:])
    owner = np.repeat(np.arange(part.size), 1 + part.per_text_bytes(part.data == NEWLINE))
    full = solid[ends] > solid[starts]
    return starts[full], ends[full], owner[full]


def measure(part: Slice, rules: RepetitionRules) -> dict[str, np.ndarray]:
    starts, ends, owner = part.words()
    letters = np.zeros(len(part.data) + 1, dtype=np.int64)
    np.cumsum((part.data & 0xC0) != 0x80, out=letters[1:])
    size = letters[ends] - letters[starts]
    hashes = word_hashes(part)
    out = {
        "n_words": part.per_text(owner),
        "word_chars": part.per_text(owner, size).astype(np.int64),
        "n_symbols": part.per_text_bytes(SYMBOLS[part.data]),
    }

    line_start, line_end, line_owner = _lines(part)
    line_hash = span_hashes(BYTE_VALUE[part.data], line_start, line_end, BYTE_POWERS)
    repeated = _runs(_keyed(line_hash, line_owner))[1]
    out["n_dup_lines"] = part.per_text(line_owner[repeated])
    solid = np.zeros(len(part.data) + 1, dtype=np.int64)
    np.cumsum(~SPACE[part.data] & ((part.data & 0xC0) != 0x80), out=solid[1:])
    in_line = solid[line_end] - solid[line_start]
    out["dup_line_chars"] = part.per_text(
        line_owner[repeated], in_line[repeated]
    ).astype(np.int64)

    windows, first = window_hashes(hashes, owner, rules.window)
    shared, _ = _runs(_keyed(windows, owner[first]))
    inside = _covered(first[shared], rules.window, len(owner))
    out["n_repeat_words"] = part.per_text(owner[inside])
    # A longer n-gram can only be repeated where all windows inside it are.
    repeats = np.zeros(len(owner) + 1, dtype=np.int64)
    flags = np.zeros(len(owner), dtype=bool)
    flags[first[shared]] = True
    np.cumsum(flags, out=repeats[1:])
    for n in rules.ngram_share:
        if n >= rules.window:
            begin = np.arange(max(0, len(owner) - n + 1))
            needed = n - rules.window + 1
            begin = begin[repeats[begin + needed] - repeats[begin] == needed]
        else:
            begin = window_hashes(hashes, owner, n)[1]
        begin = begin[owner[begin] == owner[begin + n - 1]] if len(begin) else begin
        keys = _n_hashes(hashes, begin, n)
        later = _runs(_keyed(keys, owner[begin]))[1]
        held = _covered(begin[later], n, len(owner))
        out[f"dup_{n}gram_chars"] = part.per_text(owner[held], size[held]).astype(np.int64)
    return out


def _n_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    keys = np.zeros(len(first), dtype=np.uint64)
    for i in range(n):
        keys = mix(keys + hashes[first + i])
    return keys


def repetition_quality(
    documents: DataFrame, rules: RepetitionRules | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its repetition figures and the verdict ``kept``.

    A document is dropped when it has fewer than ``min_words`` words, when more than
    ``max_repeat_words`` of them stand in windows found twice or more (``base_failed``), or when
    a share of its word characters stands in repeated lines or n-grams beyond the limits.
    Null and empty texts have no words and are dropped; repeated rows are judged each by itself;
    an empty table gives an empty table; other columns are not read.
    """
    rules = rules or RepetitionRules()
    ship_package(documents.sparkSession)
    figures = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
        *(f"dup_{n}gram_chars" for n in rules.ngram_share),
    ]
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for part in slices(texts):
                got = measure(part, rules)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.first, part.size)]
                    + [pa.array(got[name].astype(np.int64)) for name in figures],
                    names=["_id", *figures],
                )

    schema = f"_id {kind}, " + ", ".join(f"{name} long" for name in figures)
    measured = source.mapInArrow(run, schema)
    base_failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") > rules.max_repeat_words * F.col("n_words")
    )
    excess = F.col("dup_line_chars") > rules.max_dup_line_share * F.col("word_chars")
    for n, share in rules.ngram_share.items():
        excess = excess | (F.col(f"dup_{n}gram_chars") > share * F.col("word_chars"))
    return (
        measured.withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~excess)
        .withColumnRenamed("_id", id_column)
    )
