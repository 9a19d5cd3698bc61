"""Small corpora for the tests, and documents that every operator must stand."""

import random

SCHEMA = "doc_id long, text string, score double, _text string, key long"

ODD_TEXTS = [
    None, "", " \t\n", "one", "\n\n", "İ Σ 日本語 é́ ½", "a b\x1cc", "<|endoftext|> it's 'll",
    "word " * 3000, "x" * 20_000,
]


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    made = [f"{rng.choice('abcdefghij')}{rng.randrange(vocabulary):x}" for _ in range(words)]
    return " ".join(w + ("." if rng.random() < 0.08 else "") for w in made)


def frame(spark, texts, first=0):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(first + i, t, 0.5, "other", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def odd(spark):
    """Nulls in id and text, empty and long texts, and a row that comes twice."""
    rows = [(i, t, 0.5, "other", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", None, None, None), (3, "one", 0.5, "other", 7)]
    return spark.createDataFrame(rows, SCHEMA)
