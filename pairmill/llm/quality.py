"""Quality classifier learned from trusted positives and unlabelled text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.pu import LinearModel, PuSettings, fit
from pairmill.llm.repetition import SYMBOLS, _covered, _keyed, _runs
from pairmill.llm.sampling import fold, pu_sample, sampled_documents
from pairmill.llm.scan import LOWER, Slice, slices, window_hashes, word_hashes
from pairmill.session import ship_package

UPPER = LOWER != np.arange(256)
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:?")] = True
MARK = np.zeros(256, bool)
MARK[list(b"!")] = True
PIPE = np.zeros(256, bool)
PIPE[list(b"|")] = True
OTHER = np.zeros(256, bool)
OTHER[list(b"/\\_=+~^@{}[]()\"'`-")] = True
BREAK = np.zeros(256, bool)
BREAK[10] = True

FEATURES = 24


def style_features(part: Slice) -> np.ndarray:
    """Shares and lengths that tell running text from lists, shouting and debris; no word lists."""
    starts, ends, owner = part.words()
    data = part.data
    letters = np.maximum(part.per_text_bytes((data & 0xC0) != 0x80), 1)
    words = part.per_text(owner)
    least = np.maximum(words, 1)
    size = ends - starts

    def share(flags):
        return part.per_text_bytes(flags) / letters

    def of_words(flags):
        return part.per_text(owner[flags]) / least

    symbol, upper = SYMBOLS[data], UPPER[data]
    held = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(symbol | MARK[data], out=held[1:])
    shouted = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(upper, out=shouted[1:])
    hashes = word_hashes(part, lower=True)
    again = _runs(_keyed(hashes, owner))[1]
    windows, first = window_hashes(hashes, owner, 3)
    repeated = _covered(first[_runs(_keyed(windows, owner[first]))[0]], 3, len(owner))
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    lines = part.per_text_bytes(BREAK[data]) + 1
    mean = part.per_text(owner, size) / least
    spread = np.sqrt(np.maximum(part.per_text(owner, size.astype(float) ** 2) / least - mean**2, 0))
    columns = [
        share(symbol), share(upper), share(DIGIT[data]), share(STOP[data]), share(MARK[data]),
        share(PIPE[data]), share(OTHER[data]), share(BREAK[data]),
        of_words(held[ends] > held[starts]), of_words(size == 1),
        of_words(shouted[ends] - shouted[starts] >= 2), of_words(STOP[last]),
        of_words(size <= 3), of_words(size >= 12), of_words(again), of_words(repeated),
        mean / 10, spread / 10, np.log1p(words) / 10, np.log1p(words / lines) / 10,
        (words < 20).astype(float), (words < 50).astype(float),
    ]
    shares = np.stack(columns, axis=1)
    # Square roots tell small shares from none.
    roots = np.sqrt(shares[:, [0, 4]])
    return np.concatenate([shares, roots], axis=1).astype(np.float32)


class QualityModel:
    """A linear score of standardised style features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, linear: LinearModel):
        self.centre, self.scale, self.linear = centre, scale, linear

    def score(self, part: Slice) -> np.ndarray:
        return self.linear.score(standard(style_features(part), self.centre, self.scale))


def standard(features: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((features - centre) / scale, -6, 6)


def fit_quality(
    documents: DataFrame, labels: DataFrame, settings: PuSettings | None = None, folds: int = 3,
    held_out: int = 1, id_column: str = "doc_id", text_column: str = "text",
) -> QualityModel:
    """Fits on at most the settings' numbers of trusted positives and unlabelled documents.

    Their features, a few hundred bytes each, come to the driver, which trains in numpy. The
    class prior is the share of positives among the labelled rows outside the held-out fold.
    """
    settings = settings or PuSettings()
    ship_package(documents.sparkSession)
    sample = pu_sample(documents, labels, "quality", folds, held_out, settings, id_column)
    chosen = sampled_documents(documents, sample, id_column, text_column)

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(1)):
                values = style_features(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.size),
                        pa.array(list(values), pa.list_(pa.float32())),
                    ],
                    names=["positive", "features"],
                )

    rows = chosen.select("positive", "_text").mapInArrow(run, "positive boolean, features array<float>")
    # Sorted, so that the fit does not depend on the order in which tasks end.
    found = rows.toPandas()
    values = np.array(found["features"].tolist(), dtype=np.float64).reshape(len(found), FEATURES)
    flags = found["positive"].to_numpy(dtype=bool)
    order = np.lexsort([*values.T, flags])
    values, flags = values[order], flags[order]
    centre = values.mean(axis=0) if len(values) else np.zeros(FEATURES)
    scale = values.std(axis=0) + 1e-3 if len(values) else np.ones(FEATURES)
    values = standard(values, centre, scale)
    linear = fit(values[flags], values[~flags], sample.prior, settings)
    return QualityModel(centre, scale, linear)


def with_score(
    documents: DataFrame, model, score_column: str, text_column: str = "text"
) -> DataFrame:
    """All columns and rows of the documents, with the model's score of each text."""
    ship_package(documents.sparkSession)
    place = documents.columns.index(text_column)
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields
    )

    def run(batches):
        for batch in batches:
            scores = [model.score(part) for part in slices(batch.column(place))]
            if scores:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.concatenate(scores).astype(np.float64))],
                    names=[*batch.schema.names, score_column],
                )

    return documents.mapInArrow(run, f"{schema}, `{score_column}` double")


def quality_scores(
    documents: DataFrame, labels: DataFrame, settings: PuSettings | None = None,
    threshold: float = 0.5, folds: int = 3, held_out: int = 1, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (id, held_out, score, predicted), one per document.

    Scores lie between 0 and 1, higher for texts like the trusted ones. Null texts score as empty
    ones; repeated rows score alike; an empty table gives an empty table; without labels every
    document scores the prior. Only the text is an input of the score.
    """
    model = fit_quality(documents, labels, settings, folds, held_out, id_column, text_column)
    return _scored(documents, model, threshold, folds, held_out, id_column, text_column)


def _scored(documents, model, threshold, folds, held_out, id_column, text_column):
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    scored = with_score(source, model, "score", "_text")
    return scored.select(
        F.col("_id").alias(id_column),
        F.coalesce(fold(F.col("_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
