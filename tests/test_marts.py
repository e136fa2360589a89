"""Mart tests on hand-made store rows (read from raw CSV)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.plans import marts as M
from bazaar.sources import dimensions as D
from tests.fixtures import load, write_raw


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw"))
    write_raw(base)
    return load(spark, base)


@pytest.fixture(scope="module")
def m1(raw):
    return M.order_reviews(raw["orders"], raw["customers"], raw["state_codes"], raw["order_reviews"])


@pytest.fixture(scope="module")
def m2(spark, raw):
    return M.order_products_payments(raw["order_items"], raw["products"],
                                     D.category_translation(spark), raw["order_payments"])


def test_csv_quoted_newline_and_bom(raw):
    msgs = {r.review_id: r.review_comment_message for r in raw["order_reviews"].collect()}
    assert msgs["r1"] == "Muito bom, recomendo\nchegou rápido"
    assert msgs["r2"] == 'produto "top"'
    assert raw["state_codes"].columns == ["subdivision", "name"]
    assert raw["order_reviews"].count() == 7


def test_m1_order_reviews(m1):
    assert len(m1.columns) == 19
    rows = {r.review_id: r for r in m1.collect()}
    # o6's state XX has no name -> dropped by the inner join; o1 has 2 reviews
    assert set(rows) == {"r1", "r2", "r3", "r4", "r5", "r6"}
    assert rows["r1"].arrival_days == 31 and rows["r1"].numeric_order_status == 1
    assert rows["r3"].arrival_days is None                 # NULL delivery
    assert rows["r4"].order_purchase_timestamp is None     # unparseable timestamp
    assert rows["r5"].arrival_days == -2                   # delivered 26 h before purchase
    assert rows["r1"].name == "Sao Paulo" and rows["r3"].numeric_order_status == 2
    assert "review_comment_message" not in m1.columns


def test_m3_m4_means(m1):
    city = {r.customer_city: (r.arrival_days, r.review_score) for r in M.arrival_by_city(m1).collect()}
    # sao paulo: arrival 31, 31, NULL(o3), -2 -> mean 20.0; scores 5, 4, 3, 2 -> 3.5
    assert city["sao paulo"] == (20.0, 3.5)
    assert "rio de janeiro" not in city            # its only arrival is NULL -> dropped (P10)
    state = {r.name: r.arrival_days for r in M.arrival_by_state(m1).collect()}
    assert state["Rio de Janeiro"] == 10.0         # o2 NULL skipped, o5 = 10


def test_m10_on_time_by_month(m1):
    rows = {(r.year, r.month): r for r in M.on_time_by_month(m1).collect()}
    # o1: approved Dec 2017, delivered Jan -> key (2017, 1); 31 < 39 -> at time (x2 reviews)
    assert rows[("2017", "1")].at_time == 100.0 and rows[("2017", "1")].no_at_time == 0.0
    assert rows[("2017", "1")].first == dt.date(2017, 1, 1)
    assert rows[("2017", "1")].last == dt.date(2017, 1, 31)
    # o5: arrival 10 == estimate 10 -> 'no'; o4: -2 < 14 -> at time; both 2018
    assert rows[("2018", "2")].at_time == 0.0
    assert rows[("2018", "3")].at_time == 100.0
    # o2 (NULL delivery) and o3 (bad purchase timestamp) are dropped
    assert set(rows) == {("2017", "1"), ("2018", "2"), ("2018", "3")}


def test_m2_fanout_and_categories(m2):
    rows = m2.collect()
    # o1: 2 items x 2 payments; o2 item p5; o4 item p1; o5 item p3
    assert sum(1 for r in rows if r.order_id == "o1") == 4
    cats = {r.product_id: r.product_principal_category for r in rows}
    assert cats["p1"] == "beauty" and cats["p3"] == "cars" and cats["p5"] == "home"
    # pc_gamer has a group but no translation -> dropped by the inner join
    assert "p2" not in cats


def test_m14_count_over_join(m1, m2):
    rows = {r.order_id: r for r in M.order_rows_by_month(m1, m2).collect()}
    # o1: 2 reviews x (2 items x 2 payments) = 8
    assert rows["o1"].product_id == 8 and (rows["o1"].year, rows["o1"].month) == ("2017", "12")
    assert rows["o2"].product_id == 1
    assert "o3" not in rows            # no items
    # same numbers as the plain join-then-count
    j = m1.where(F.col("order_approved_at").isNotNull()).join(m2, "order_id")
    plain = {r.order_id: r.c for r in j.groupBy("order_id").agg(F.count("product_id").alias("c")).collect()}
    assert plain == {k: v.product_id for k, v in rows.items()}


def test_m5_orders_payment(raw):
    rows = M.orders_payment(raw["orders"], raw["order_payments"]).collect()
    assert len(rows) == 5
    o1 = sorted(r.order_value for r in rows if r.order_id == "o1")
    assert o1 == [15.0, 16.0]
    assert {r.month_yr for r in rows if r.order_id == "o1"} == {"Dec-2017"}


def test_m6_m7_m8_m9(raw):
    ql = M.qualified_leads(raw["leads"], raw["closed_deals"])
    assert ql.columns == ["landing_page_id", "origin", "seller_id", "business_segment", "lead_type",
                          "lead_behaviour_profile", "business_type"]
    assert ql.count() == 3
    cltv = {r.seller_id: r for r in M.seller_cltv(raw["order_items"], raw["sellers"]).collect()}
    assert cltv["s1"].cltv == 40.0 and cltv["s2"].cltv == 60.0
    assert cltv["s3"].cltv == 0.0                     # all prices NULL (T7)
    assert cltv["s1"].seller_zip_code_prefix == 1001  # leading zero lost (T20)
    lc = {r.seller_id: r.cltv for r in M.lead_cltv(ql, raw["order_items"]).collect()}
    assert lc == {"s1": 40.0, "s2": 60.0, "s3": 0.0}  # price 0 -> no change (T17)
    lc2 = {r.seller_id: r.cltv for r in M.lead_cltv(ql, raw["order_items"], 5.0).collect()}
    assert lc2["s1"] == 35.0 and lc2["s2"] == 60.0
    assert len(M.closed_deals(raw["closed_deals"]).columns) == 10


def test_m11_m12_leads(raw):
    rows = {(r.year, r.month, r.origin): r["count"] for r in M.leads_by_month_origin(raw["leads"]).collect()}
    # m3 (NULL origin) and m4 (bad date) form no group
    assert rows == {("2018", "1", "paid_search"): 1, ("2018", "1", "organic_search"): 1,
                    ("2018", "2", "paid_search"): 1}
    counts = [(r.origin, r["count"]) for r in M.leads_by_origin(raw["leads"]).collect()]
    assert counts == [("paid_search", 3), ("organic_search", 1)]


def test_m13_geolocation(raw):
    rows = M.geolocation(raw["geolocation"]).collect()
    assert rows[0].location == "-23.5456,-46.6393" and rows[1].location is None
    assert len(rows[0]) == 6
