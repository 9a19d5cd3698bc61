"""Toxicity classifier learned from confirmed toxic examples and unlabelled text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.pu import LinearModel, PuSettings, fit, sigmoid
from pairmill.llm.quality import _scored
from pairmill.llm.sampling import Sample, pu_sample, sampled_documents
from pairmill.llm.scan import BYTE_POWERS, BYTE_VALUE, LOWER, Slice, Spans, mix, slices
from pairmill.session import ship_package

# Terms that the classifier looks for: those most typical of the toxic examples.
TERMS = 512
# A term must stand in so many toxic examples.
LEAST_EXAMPLES = 3
# Log-likelihood that a term's share of toxic examples must gain over its share of all text; chance
# alone reaches it rarely, also among millions of terms.
LEAST_GAIN = 9.0
# A term is a whole word or its first so many bytes, standing in the text at least so many times.
PREFIXES = (4, 5, 6, 7, 8)
TIMES = 3

LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class ToxicitySettings(PuSettings):
    terms: int = TERMS
    least_examples: int = LEAST_EXAMPLES
    max_positive: int = 5_000
    max_unlabelled: int = 10_000
    # Few examples are positive, so the risk of a small batch is often negative by chance.
    batch: int = 2048
    epochs: int = 80
    decay: float = 3e-4


def stems(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and text numbers of the lower-cased runs of letters and of their prefixes."""
    data = LOWER[part.data]
    # Upper-case Latin-1 letters are C3 80..9E in UTF-8, but for C3 97.
    second = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    second = second[data[second] != 0x97]
    data[second] += 0x20
    solid = LETTERS[data]
    before = np.zeros_like(solid)
    before[1:] = solid[:-1]
    inner = part.bounds[:-1][part.bounds[:-1] < len(solid)]
    before[inner] = False
    begins = solid & ~before
    starts = np.flatnonzero(begins)
    after = np.zeros_like(solid)
    after[:-1] = solid[1:] & ~begins[1:]
    ends = np.flatnonzero(solid & ~after) + 1
    owner = np.searchsorted(part.bounds, starts, side="right") - 1
    spans = Spans(BYTE_VALUE[data], BYTE_POWERS)
    hashes, owners = [spans.hashes(starts, ends)], [owner]
    for size in PREFIXES:
        longer = ends - starts > size
        begin = starts[longer]
        # Another number than that of the same letters as a whole word.
        hashes.append(spans.hashes(begin, begin + size) ^ np.uint64(size))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners)


def repeated_terms(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A term for each stem of a text and each count up to ``TIMES`` that it reaches."""
    order = np.lexsort([hashes, owner])
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
    kept = place < TIMES
    return mix(hashes[kept] + place[kept].astype(np.uint64)).view(np.int64), owner[kept]


def _with_stems(stem: np.ndarray, at: np.ndarray, owner: np.ndarray):
    """Terms, text numbers and stems, where ``at`` numbers the stems of the texts."""
    order = np.lexsort([at, owner])
    at, owner = at[order], owner[order]
    terms, owners = repeated_terms(stem[at], owner)
    first = np.ones(len(at), dtype=bool)
    first[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(first)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    return terms, owners, stem[at[place < TIMES]]


class TermModel:
    """A linear score of which terms a text holds; a text's length does not thin them out."""

    def __init__(self, terms: np.ndarray, stem_hashes: np.ndarray, linear: LinearModel):
        order = np.argsort(terms)
        self.terms, self.weights, self.bias = terms[order], linear.weights[order], linear.bias
        self.stems = np.unique(stem_hashes)

    def found(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(term number, text number) pairs, ordered by text."""
        hashes, owner = stems(part)
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.stems, hashes), len(self.stems) - 1)
        hit = self.stems[at] == hashes
        terms, owner = repeated_terms(hashes[hit], owner[hit])
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        return at[known], owner[known]

    def score(self, part: Slice) -> np.ndarray:
        term, owner = self.found(part)
        return sigmoid(part.per_text(owner, self.weights[term]) + self.bias)


def _typical_terms(
    chosen: DataFrame, sample: Sample, settings: ToxicitySettings
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms, and of their stems, whose share of toxic examples exceeds that of unlabelled text most.

    Ranked by the likelihood ratio of the two shares; a task sends each term once per batch.
    """

    def run(batches):
        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                hashes, owner = stems(part)
                stem, at = np.unique(hashes, return_inverse=True)
                terms, owner, stem = _with_stems(stem, at, owner)
                toxic = flags[part.first + owner]
                terms, chosen_at, place = np.unique(terms, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(terms), pa.array(stem[chosen_at].view(np.int64)),
                        pa.array(np.bincount(place[toxic], minlength=len(terms))),
                        pa.array(np.bincount(place[~toxic], minlength=len(terms))),
                    ],
                    names=["term", "stem", "toxic", "plain"],
                )

    counted = (
        chosen.select("positive", "_text").mapInArrow(run, "term long, stem long, toxic long, plain long")
        .groupBy("term", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
        .where(F.col("toxic") >= min(settings.least_examples, max(1, sample.positives // 4)))
    )
    share_t = F.col("toxic") / F.lit(float(max(sample.positives, 1)))
    share_u = (F.col("plain") + 0.5) / F.lit(float(max(sample.unlabelled, 1)))
    ranked = (
        counted.where(share_t > share_u)
        .withColumn(
            "gain",
            F.col("toxic") * (F.log(share_t / share_u) - 1) + sample.positives * share_u,
        )
        .where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "term").limit(settings.terms)
    )
    rows = ranked.select("term", "stem").collect()
    terms = np.array([r["term"] for r in rows], dtype=np.int64)
    return terms, np.array([r["stem"] for r in rows], dtype=np.int64).view(np.uint64)


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, settings: ToxicitySettings | None = None,
    folds: int = 4, held_out: int = 2, id_column: str = "doc_id", text_column: str = "text",
) -> TermModel:
    """Fits on at most the settings' numbers of toxic examples and unlabelled documents.

    Which of the chosen terms each sampled document holds comes to the driver, which trains in
    numpy. The class prior is the toxic share of the labelled rows outside the held-out fold.
    """
    settings = settings or ToxicitySettings()
    ship_package(documents.sparkSession)
    sample = pu_sample(documents, labels, "toxic", folds, held_out, settings, id_column)
    chosen = sampled_documents(documents, sample, id_column, text_column)
    terms, stem_hashes = _typical_terms(chosen, sample, settings)
    finder = TermModel(terms, stem_hashes, LinearModel(np.zeros(len(terms)), 0.0))

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(1)):
                term, owner = finder.found(part)
                cuts = np.searchsorted(owner, np.arange(part.size + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.size),
                        pa.ListArray.from_arrays(
                            pa.array(cuts, pa.int32()), pa.array(term.astype(np.int32))
                        ),
                    ],
                    names=["positive", "terms"],
                )

    rows = chosen.select("positive", "_text").mapInArrow(run, "positive boolean, terms array<int>")
    found = sorted((bool(r["positive"]), tuple(r["terms"])) for r in rows.collect())
    values = np.zeros((len(found), len(terms)), dtype=np.uint8)
    for row, (_, held) in enumerate(found):
        values[row, list(held)] = 1
    flags = np.array([f for f, _ in found], dtype=bool)
    linear = fit(values[flags], values[~flags], sample.prior, settings)
    return TermModel(finder.terms, stem_hashes, linear)


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, settings: ToxicitySettings | None = None,
    threshold: float = 0.3, folds: int = 4, held_out: int = 2, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (id, held_out, score, predicted), one per document.

    Scores lie between 0 and 1, higher for texts like the toxic examples. Null texts score as
    empty ones; repeated rows score alike; an empty table gives an empty table; without labels
    every document scores the prior. Only the text is an input of the score.
    """
    model = fit_toxicity(documents, labels, settings, folds, held_out, id_column, text_column)
    return _scored(documents, model, threshold, folds, held_out, id_column, text_column)
