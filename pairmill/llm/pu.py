"""Learning from positive and unlabelled rows with the non-negative unbiased risk."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class PuSettings:
    """``max_positive`` and ``max_unlabelled`` bound the sample that a classifier is fitted on."""

    max_positive: int = 20_000
    max_unlabelled: int = 20_000
    epochs: int = 60
    batch: int = 512
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(features @ self.weights + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def estimated_prior(positive: int, labelled: int) -> float:
    """The share of positives, from how many of the labelled rows are; away from 0 and 1."""
    return (positive + 0.5) / (labelled + 1.0)


def risk_parts(margin_p: np.ndarray, margin_u: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk of positives, unbiased risk of negatives) under the logistic loss.

    The second is an estimate from unlabelled rows less the positives among them. Its expectation
    is not negative, but on a sample it can be; the non-negative risk takes 0 instead.
    """
    as_positive = prior * float(np.logaddexp(0, -margin_p).mean())
    as_negative = float(np.logaddexp(0, margin_u).mean())
    return as_positive, as_negative - prior * float(np.logaddexp(0, margin_p).mean())


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: PuSettings | None = None
) -> LinearModel:
    """Minimises prior·R+(P) + max(0, R-(U) − prior·R-(P)) by Adam over mini-batches.

    Where the second part is negative in a batch, the step goes against it, so that the model
    does not learn the unlabelled rows by heart. Without positives or unlabelled rows every
    document scores the prior.
    """
    settings = settings or PuSettings()
    size = positive.shape[1]
    bias = float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return LinearModel(np.zeros(size), bias)
    random = np.random.default_rng(settings.seed)
    theta = np.zeros(size + 1)
    theta[-1] = bias
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    rounds = max(1, min(60, max(len(positive), len(unlabelled)) // settings.batch))
    total = settings.epochs * rounds
    for _ in range(total):
        drawn = [
            rows[random.integers(0, len(rows), min(settings.batch, len(rows)))].astype(np.float64)
            for rows in (positive, unlabelled)
        ]
        p, u = drawn
        margin_p, margin_u = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
        negative = risk_parts(margin_p, margin_u, prior)[1]
        pull_u = sigmoid(margin_u) / len(u)
        pull_p = -prior * sigmoid(margin_p) / len(p)
        if negative < 0:
            pull_u, pull_p = -pull_u, -pull_p
        else:
            pull_p = pull_p - prior * sigmoid(-margin_p) / len(p)
        gradient = np.empty_like(theta)
        gradient[:-1] = pull_p @ p + pull_u @ u + settings.decay * theta[:-1]
        gradient[-1] = pull_p.sum() + pull_u.sum()
        step += 1
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = settings.rate * (1 - (step - 1) / total)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LinearModel(theta[:-1].copy(), float(theta[-1]))
