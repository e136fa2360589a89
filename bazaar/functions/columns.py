"""Scalar column functions (built-in expressions only, all codegen'd).

Each returns a ``Column``; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.sources.dimensions import CATEGORY_GROUPS, ORDER_STATUS_LABELS

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_or_null(x) -> Column:
    """Parse text to a timestamp without a zone, as the store writes them, so
    that elapsed days hold in any session zone (T1); unparseable text gives
    NULL (trap T2)."""
    return _c(x).try_cast("timestamp_ntz")


def ts_strict(x) -> Column:
    """The same, but unparseable text fails the query (T3), in any session."""
    parsed = ts_or_null(x)
    wrong = F.raise_error(F.concat(F.lit("not a timestamp: "), _c(x)))
    return F.when(_c(x).isNotNull() & parsed.isNull(), wrong.cast("timestamp_ntz")).otherwise(parsed)


def as_timestamp(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Parse the named columns when they are text; leave timestamp columns
    (including ``timestamp_ntz`` from Parquet) as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parse = ts_strict if strict else ts_or_null
    out = {}
    for n in names:
        if isinstance(types[n], T.StringType):
            out[n] = parse(n)
        elif isinstance(types[n], T.DateType):
            out[n] = F.col(n).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def elapsed_days(start, end) -> Column:
    """Whole days elapsed from ``start`` to ``end``, floored (trap T1).

    ``-26 h`` gives ``-2`` and ``26 h`` gives ``1``: neither ``datediff``
    (calendar days) nor ``timestampdiff(DAY)`` (truncates toward zero) does
    this. Exact for any span: whole days are taken off before the division.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    day = F.lit(MICROS_PER_DAY)
    return F.round((micros - F.pmod(micros, day)) / day).cast("long")


def month_label(ts) -> Column:
    """``Jan-2018`` style label."""
    return F.date_format(_c(ts), "MMM-yyyy")


def period_first(year, month) -> Column:
    """First day of the month given as year and month (numbers or text)."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def period_last(year, month) -> Column:
    """Last day of that month (trap T16)."""
    return F.last_day(period_first(year, month))


def order_status_code(status, labels: Sequence[str] = ORDER_STATUS_LABELS) -> Column:
    """Label -> 1-based position in ``labels``; anything else -> 0."""
    s = _c(status)
    expr = None
    for i, label in enumerate(labels, start=1):
        expr = F.when(s == label, F.lit(i)) if expr is None else expr.when(s == label, F.lit(i))
    return expr.otherwise(F.lit(0))


def principal_category(category,
                       groups: Mapping[str, Sequence[str]] = CATEGORY_GROUPS) -> Column:
    """Category name -> group name; first group in order wins; no group ->
    ``'0'`` (T8). A CASE over bounded literal lists: no join, no shuffle."""
    c = _c(category)
    expr = None
    for group, names in groups.items():
        cond = c.isin(list(names))
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit("0"))


def delivered_on_time(arrival_days, estimated_days) -> Column:
    """``'at time'`` when arrival is strictly before the estimate, else
    ``'no'``; a NULL on either side compares false and gives ``'no'`` (T10)."""
    a, e = _c(arrival_days), _c(estimated_days)
    return F.when(a < e, F.lit("at time")).otherwise(F.lit("no"))


def location_key(lat, lng) -> Column:
    """``lat,lng`` as text; NULL when either is NULL."""
    return F.concat(_c(lat).cast("string"), F.lit(","), _c(lng).cast("string"))


def paid_search_adjusted(value, origin, price: float = 0.0,
                         paid_origin: str = "paid_search") -> Column:
    """Subtract an acquisition price from leads of one origin."""
    v = _c(value)
    return F.when(_c(origin) == paid_origin, v - F.lit(float(price))).otherwise(v)


def round_half_even(x, digits: int = 2) -> Column:
    """Banker's rounding, as numpy rounds."""
    return F.bround(_c(x), digits)


def review_score_class(score) -> Column:
    """>=4 positive, >=3 neutral, <=2 negative; between 2 and 3 (exclusive)
    or NULL -> NULL (T31)."""
    s = _c(score)
    return (F.when(s >= 4, F.lit("positive"))
            .when(s >= 3, F.lit("neutral"))
            .when(s <= 2, F.lit("negative")))


def sentiment_class(polarity) -> Column:
    """Polarity in [0.3, 1] positive, [0, 0.3) neutral, < 0 negative,
    above 1 ``'0'``; missing polarity -> neutral (T29)."""
    p = _c(polarity)
    return (F.when(p.isNull(), F.lit("neutral"))
            .when((p >= 0.3) & (p <= 1), F.lit("positive"))
            .when((p >= 0) & (p < 0.3), F.lit("neutral"))
            .when(p < 0, F.lit("negative"))
            .otherwise(F.lit("0")))
