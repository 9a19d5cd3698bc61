"""Fingerprints of sets of rows that repeat or not, whatever their order.

A fingerprint is the number of rows and two sums over their hashes modulo two primes. Those of disjoint
parts add up to that of the whole, so parts are compared with the whole by one aggregate: no hash is
shuffled, sorted or joined. A row that is missing, doubled or swapped for another one changes it but
for a chance of about one in 10^36.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Two primes below 2^60, and which hex digits of a hash each sum takes.
MODULI = {"sum_one": (1_000_000_000_000_000_003, 1), "sum_two": (999_999_999_999_999_989, 17)}
DIGITS = 15
FINGERPRINTS = "array<struct<side string, rows bigint, sum_one bigint, sum_two bigint>>"


def _reduced(sums: dict) -> list:
    return [(total % MODULI[name][0]).cast("bigint").alias(name) for name, total in sums.items()]


def fingerprint(rows: DataFrame, key: str = "content_hash", by: tuple = ()) -> DataFrame:
    """(rows, sum_one, sum_two) of a column of hex hashes, for all rows or by group."""
    sums = {
        name: F.coalesce(
            F.sum(F.conv(F.substring(key, start, DIGITS), 16, 10).cast("decimal(20,0)")),
            F.lit(0).cast("decimal(30,0)"),
        )
        for name, (_, start) in MODULI.items()
    }
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *_reduced(sums))


def merged(fingerprints: DataFrame, by: tuple = ()) -> DataFrame:
    """The fingerprint of several parts together."""
    sums = {
        name: F.coalesce(
            F.sum(F.col(name).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")
        )
        for name in MODULI
    }
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    return fingerprints.groupBy(*by).agg(rows, *_reduced(sums))


def side_fingerprints(sides: dict[str, DataFrame], key: str = "content_hash") -> DataFrame:
    """(side, rows, sum_one, sum_two) of several tables by one aggregate; an empty one has none."""
    named = [rows.select(F.lit(side).alias("side"), key) for side, rows in sides.items()]
    return fingerprint(reduce(DataFrame.unionByName, named), key, ("side",))


def covers(found: dict[str, tuple], whole: str, parts: tuple[str, ...]) -> bool:
    """Whether the parts, by their (rows, sum_one, sum_two), are exactly the whole."""
    none = (0, 0, 0)
    rows, one, two = found.get(whole, none)
    sums = [sum(found.get(p, none)[i] for p in parts) for i in range(3)]
    first, second = (modulus for modulus, _ in MODULI.values())
    return (rows, one, two) == (sums[0], sums[1] % first, sums[2] % second)
