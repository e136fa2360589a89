"""Small frames for the tests."""

from pyspark.sql import functions as F

CLASH = ("rule", "host", "ids", "fp", "token", "c0_", "part_", "nth_", "found_", "root", "vector", "id", "payload", "sha1", "n")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """The frame with extra columns whose names the operators use themselves,
    and one that differs from the first column by case only."""
    extra = [F.lit("x").alias(n) for n in CLASH if n not in df.columns]
    return df.select("*", *extra, F.lit("y").alias(df.columns[0].upper()))


def rows(df):
    return [tuple(r) for r in df.collect()]
