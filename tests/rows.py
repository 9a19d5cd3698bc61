"""Helpers to make and compare small tables."""


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def collected(frame):
    return sorted(tuple(r) for r in frame.collect())
