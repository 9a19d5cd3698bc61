import hashlib
import random

from rows import table
from pyspark.sql import functions as F

from pairmill.functions import text as T
from pairmill.functions import variants as V

CODE_POINTS = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]


def test_blank_and_strip_agree_with_python_on_every_code_point(spark):
    points = spark.createDataFrame([(c, chr(c)) for c in CODE_POINTS if c], "c int, t string")
    wrapped = F.concat("t", F.lit("a"), "t")
    rows = points.select(
        "c", T.nonblank(F.col("t")).alias("nonblank"), T.strip(wrapped).alias("stripped")
    ).collect()
    for c, nonblank, stripped in rows:
        assert nonblank == bool(chr(c).strip()), hex(c)
        assert stripped == (chr(c) + "a" + chr(c)).strip(), hex(c)


def test_blank_cases(spark):
    cases = [None, "", " ", "\t\n", " ", "　", "\x1c\x1f", "\x85", "​", "﻿", " a "]
    rows = table(spark, [(c,) for c in cases], "t string").select(T.nonblank(F.col("t"))).collect()
    assert [r[0] for r in rows] == [False] * 8 + [True] * 3


def test_hash_and_code_points_agree_with_python(spark):
    draw = random.Random(7)
    texts = [
        "".join(chr(draw.choice(CODE_POINTS)) for _ in range(draw.randrange(20)))
        for _ in range(400)
    ]
    pairs = list(zip(texts[::2], texts[1::2]))
    rows = table(spark, pairs, "a string, b string").select(
        "a", "b", T.content_hash(F.col("a"), F.col("b")), T.codepoints(F.col("a"))
    )
    for a, b, digest, points in rows.collect():
        assert digest == hashlib.sha256(f"{a}\0{b}".encode()).hexdigest()
        assert points == [ord(c) for c in a]


def test_truthiness(spark):
    cases = {
        "null": False, "0": False, "0.0": False, "false": False, '""': False, "[]": False,
        "{}": False, "1": True, "-2.5": True, "true": True, '"0"': True, '"false"': True,
        '"[]"': True, "[0]": True, '{"a":0}': True, "[null]": True,
    }
    rows = table(spark, [(c,) for c in cases], "t string").select(
        "t", V.truthy(F.parse_json("t"))
    )
    assert {t: v for t, v in rows.collect()} == cases


def test_guarded_json_is_exactly_one_value(spark):
    cases = {"{}": True, " [1] ": True, "{} x": False, '{"a":1}{"b":2}': False, "": False,
             "1,0": False, "1": True, "[1": False, "{'a':1}": False,
             '{"choices":[]},0]': False, "{},0] x": False, "{} , 0.0 ]": False, '{},"0"]': False}
    rows = table(spark, [(c,) for c in cases], "t string").select(
        "t", V.is_complete(V.parse_guarded(F.col("t")), F.col("t"))
    )
    assert {t: v for t, v in rows.collect()} == cases
