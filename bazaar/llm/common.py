"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.session import shared_dir, stored  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with columns named by position, and the original names, so
    that no helper column can clash with a column of the caller."""
    names = df.columns
    return df.toDF(*[f"c{i}_" for i in range(len(names))]), names


def position(names: list[str], name: str) -> str:
    """Positional name of a column: the exact name, else ignoring case."""
    low = [n.lower() for n in names]
    i = names.index(name) if name in names else low.index(name.lower())
    return f"c{i}_"


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to the given types; other columns are
    dropped, also those whose names differ from a wanted one by case only."""
    pos, names = positional(df)
    return pos.select(*[F.col(position(names, n)).cast(t).alias(n) for n, t in types.items()])


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
