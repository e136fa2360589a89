
import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.functions import columns as C
from bazaar.operators import aggregates as A
from bazaar.sources import dimensions as D


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_t1_elapsed_days_floor(spark):
    rows = [(dt.datetime(2020, 1, 2, 2), dt.datetime(2020, 1, 1, 0)),   # -26 h
            (dt.datetime(2020, 1, 1, 0), dt.datetime(2020, 1, 2, 2)),   # +26 h
            (dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1))]  # 2 h, next day
    got = one(spark, C.elapsed_days("a", "b"), rows, "a timestamp, b timestamp")
    assert got == [-2, 1, 0]
    # the functions it must not be confused with
    cal = one(spark, F.datediff("b", "a"), rows, "a timestamp, b timestamp")
    assert cal != got


def test_t1_elapsed_days_ntz(spark):
    df = spark.sql("select timestamp_ntz'2020-01-02 02:00:00' a, timestamp_ntz'2020-01-01 00:00:00' b")
    assert df.select(C.elapsed_days("a", "b")).first()[0] == -2


def test_t2_unparseable_is_null(spark):
    got = one(spark, C.ts_or_null("s"), [("2018-01-02 10:00:00",), ("not a date",), (None,)], "s string")
    assert got[0] == dt.datetime(2018, 1, 2, 10) and got[1] is None and got[2] is None


def test_t1_days_hold_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-13 12:00:00", "2021-03-14 12:00:00")], "a string, b string")
        for strict in (True, False):  # 23 hours on the clock of that night, a day in the store's time
            t = C.as_timestamp(df, ["a", "b"], strict)
            assert t.select(C.elapsed_days("a", "b")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_t1_exact_for_long_spans(spark):
    df = spark.createDataFrame([("0001-01-01 00:00:01", "9999-12-31 00:00:00"), ("9999-12-31 00:00:00", "0001-01-01 00:00:01")],
                               "a string, b string")
    t = C.as_timestamp(df, ["a", "b"])
    assert [r[0] for r in t.select(C.elapsed_days("a", "b")).collect()] == [3652057, -3652058]


def test_t3_strict_parse_fails(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("junk",)], "s string").select(C.ts_strict("s")).collect()


def test_t6_null_keys_form_no_group(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in A.group_mean(df, ["k"], ["v"]).collect()}
    assert got == {"a": 2.0}


def test_t7_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([("s1", None), ("s1", None), ("s2", 5.0)], "k string, v double")
    got = {r["k"]: r["s"] for r in A.group_sum(df, ["k"], "v", "s").collect()}
    assert got == {"s1": 0.0, "s2": 5.0}


def test_t8_unmatched_codes(spark):
    rows = [(s,) for s in list(D.ORDER_STATUS_LABELS) + ["weird", None]]
    got = one(spark, C.order_status_code("s"), rows, "s string")
    assert got == [1, 2, 3, 4, 5, 6, 7, 8, 0, 0]
    cats = one(spark, C.principal_category("c"), [("perfumaria",), ("pc_gamer",), ("nope",)], "c string")
    assert cats == ["beauty", "electronics", "0"]


def test_t9_group_lists_cover_translation():
    names = {n for ns in D.CATEGORY_GROUPS.values() for n in ns}
    translated = {a for a, _ in D.translation_rows()}
    assert len(names) == 73 and len(translated) == 71
    assert translated <= names
    assert names - translated == {"pc_gamer", "portateis_cozinha_e_preparadores_de_alimentos"}


def test_t10_null_comparison_is_no(spark):
    got = one(spark, C.delivered_on_time("a", "e"), [(1, 2), (2, 2), (None, 2), (3, 2)], "a int, e int")
    assert got == ["at time", "no", "no", "no"]


def test_t13_half_even(spark):
    got = one(spark, C.round_half_even("x", 2), [(0.125,), (0.375,), (3.125,)], "x double")
    assert got == [0.12, 0.38, 3.12]


def test_t15_t16_period(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 2, 9),)], "t timestamp")
    r2 = df.select(C.period_first(F.lit("2020"), F.lit("2")).alias("f"),
                   C.period_last(F.lit("2020"), F.lit("2")).alias("l")).first()
    assert (r2.f, r2.l) == (dt.date(2020, 2, 1), dt.date(2020, 2, 29))


def test_month_label(spark):
    got = one(spark, C.month_label("t"), [(dt.datetime(2018, 1, 5),), (dt.datetime(2017, 12, 31),)], "t timestamp")
    assert got == ["Jan-2018", "Dec-2017"]


def test_t17_paid_search_adjustment(spark):
    df = spark.createDataFrame([("paid_search", 10.0), ("organic", 10.0)], "o string, v double")
    assert one(spark, C.paid_search_adjusted("v", "o", 0.0), df.collect(), df.schema) == [10.0, 10.0]
    assert one(spark, C.paid_search_adjusted("v", "o", 3.0), df.collect(), df.schema) == [7.0, 10.0]


def test_t23_location_key(spark):
    got = one(spark, C.location_key("a", "b"), [(-23.5, -46.25), (None, 1.0)], "a double, b double")
    assert got == ["-23.5,-46.25", None]


def test_t29_sentiment_class(spark):
    rows = [(None,), (0.3,), (1.0,), (0.29,), (0.0,), (-0.01,), (1.5,)]
    got = one(spark, C.sentiment_class("p"), rows, "p double")
    assert got == ["neutral", "positive", "positive", "neutral", "neutral", "negative", "0"]


def test_t31_review_score_class(spark):
    rows = [(5.0,), (4.0,), (3.0,), (2.5,), (2.0,), (1.0,), (None,)]
    got = one(spark, C.review_score_class("s"), rows, "s double")
    assert got == ["positive", "positive", "neutral", None, "negative", "negative", None]
