"""Grouped aggregates (A1-A9) with the source's null rules.

All are ``groupBy(...).agg(...)`` so Spark plans a partial (map-side)
aggregate before the shuffle and a final one after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.columns import period_first, period_last, round_half_even


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group keys that are NULL form no group."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """A1: sum per group; an all-NULL group sums to 0.0, not NULL."""
    return (_drop_null_keys(df, keys).groupBy(*keys)
            .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out)))


def group_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str],
               digits: int | None = None) -> DataFrame:
    """A2: mean per group of each value column (NULLs skipped)."""
    aggs = []
    for v in values:
        m = F.avg(v)
        aggs.append((F.round(m, digits) if digits is not None else m).alias(v))
    return _drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def share_pct(df: DataFrame, keys: Sequence[str], flags: Sequence[str],
              digits: int = 2) -> DataFrame:
    """A3: mean of 0/1 flags x 100, rounded half-even."""
    aggs = [round_half_even(F.avg(f) * 100.0, digits).alias(f) for f in flags]
    return _drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def count_non_null(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """A4/A5: non-NULL values of ``column`` per group."""
    return _drop_null_keys(df, keys).groupBy(*keys).agg(F.count(column).alias(out))


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Rows per non-NULL value, largest first."""
    counted = _drop_null_keys(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return counted.orderBy(F.col(out).desc(), F.col(column))


def with_period(df: DataFrame, year: str = "year", month: str = "month",
                first: str = "first", last: str = "last") -> DataFrame:
    """first and last day of the (year, month) period."""
    return df.withColumns({first: period_first(year, month), last: period_last(year, month)})
