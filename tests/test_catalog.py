"""Every registered query against its SQL, and twice under different partitioning."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry
from compare import connect, normal

from pairmill.catalog.oracle import ORACLE
from pairmill.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    got = normal(frame.collect(), frame.columns)
    assert got
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    relation = connect(SF).sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert got == normal(relation.fetchall(), relation.columns)


@pytest.mark.parametrize(
    "name", ["exact_dedup", "holdout_keys", "batch_plan", "stream_audit", "job_outcome"]
)
def test_same_result_under_other_partitioning(spark, name):
    before = [tuple(map(str, r)) for r in QUERIES[name](spark, SF).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        after = [tuple(map(str, r)) for r in QUERIES[name](spark, SF).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(before) == sorted(after)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
