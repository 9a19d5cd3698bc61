import random

import pytest
from pyspark.sql import functions as F
from rows import table

from pairmill.catalog.derive import vocabulary_file
from pairmill.operators.byte_pairs import BytePairs, byte_characters, token_ids, word_ids, words

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    "", " ", "\n\n", "Hello world, don't you'll we're 'tis I'M", "  two  spaces\t\ttabs \n line  ",
    "naïve ÉCOLE 日本語 Ελληνικά привет 😀👩‍👩‍👧", "a<|endoftext|>b", "x" * 300, "12345 ½ ² 1,000.5",
    "trailing   ", " nbsp em \x1c\x85 end", "|| | 7C|7C \\|", "aaaaabababab" * 9,
]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return BytePairs.read(spark, vocabulary_file())


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(vocabulary_file())
    made.encode_special_tokens = True
    return made


def test_every_byte_has_a_character():
    assert sorted(byte_characters().values()) == list(range(256))


def test_ids_equal_those_of_the_library(spark, vocabulary, library):
    rng = random.Random(6)
    alphabet = "aàbcdeé'sStrvlm 1²!$.\n İ日\x1c<|>½́  the ing"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(150)]
    rows = [(i % 7, i, t) for i, t in enumerate(texts)] + [(None, -1, "null key"), (1, -2, None)]
    found = token_ids(table(spark, rows, "a int, b int, text string"), "text", ["a", "b"], vocabulary)
    got = {r["b"]: r["ids"] for r in found.collect()}
    assert len(got) == len(rows) and got[-2] is None
    for _, b, text in rows[:-1]:
        assert got[b] == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_nothing_runs_in_python_and_words_are_merged_once(spark, vocabulary):
    rows = table(spark, [(i, "the same words again") for i in range(50)], "k int, text string")
    distinct = rows.select(F.explode(words(F.col("text"))).alias("word")).distinct()
    assert sorted(r["word"] for r in distinct.collect()) == [" again", " same", " words", "the"]
    found = token_ids(rows, "text", ["k"], vocabulary)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    merged = {r["word"]: r["ids"] for r in word_ids(distinct, vocabulary).collect()}
    assert all(len(ids) == 1 for ids in merged.values())


def test_other_vocabularies_are_refused(spark, folder):
    with pytest.raises(ValueError, match="byte-level"):
        BytePairs.read(spark, vocabulary_file().replace("byte_bpe_50k", "word_bpe_49k"))
