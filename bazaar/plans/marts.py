"""Store marts M1-M17 as DataFrame plans over the store schema.

Each function takes DataFrames with the store column names (see
``bazaar.sources.schemas``) and returns the mart; nothing runs until a sink
or an action. Snake-case names inside; ``EXPORT_NAMES`` holds the original
headers for ``write_mart(rename=...)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.columns import (
    as_timestamp, delivered_on_time, elapsed_days, location_key, month_label,
    order_status_code, paid_search_adjusted, principal_category,
)
from bazaar.operators.aggregates import (
    count_non_null, group_mean, group_sum, share_pct, value_counts, with_period,
)
from bazaar.operators.rules import baskets, lattice_rules
from bazaar.operators.joins import natural_join
from bazaar.operators.neighbours import (
    recommend, recommend_or_default, similar_users, user_product_ratings,
)
from bazaar.operators.lexicon import review_sentiment
from bazaar.session import stored
from bazaar.sources.dimensions import CATEGORY_GROUPS, FALLBACK_PRODUCTS
from bazaar.sources.schemas import CLOSED_DEAL_COLUMNS, QUALIFIED_LEAD_COLUMNS

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]

EXPORT_NAMES = {
    "arrival_days": "Arrival time (In Days)",
    "at_time": "at time",
    "no_at_time": "no at time",
}


# -- M1 ---------------------------------------------------------------------
def order_reviews(orders: DataFrame, customers: DataFrame, state_codes: DataFrame,
                  reviews: DataFrame) -> DataFrame:
    """M1: orders x customers (+ arrival days, status code) x state names x
    reviews, free-text review columns dropped. One row per review."""
    oc = as_timestamp(natural_join(orders, customers, "customer_id"), ORDER_TIMESTAMPS)
    oc = oc.withColumns({
        "arrival_days": elapsed_days("order_purchase_timestamp", "order_delivered_customer_date"),
        "numeric_order_status": order_status_code("order_status"),
    })
    states = state_codes.select(F.col("subdivision").alias("customer_state"), "name")
    oc = natural_join(oc, states, "customer_state")
    return natural_join(oc, reviews, "order_id").drop("review_comment_title", "review_comment_message")


# -- M2 ---------------------------------------------------------------------
def order_products_payments(items: DataFrame, products: DataFrame, translation: DataFrame,
                            payments: DataFrame,
                            groups: Mapping[str, Sequence[str]] = CATEGORY_GROUPS) -> DataFrame:
    """M2: items x (products x translation + principal category) x payments,
    at item x payment grain (T19). Whatever further columns the files hold
    pass through; one that two files share raises."""
    pt = natural_join(products, translation, "product_category_name")
    pt = pt.withColumn("product_principal_category",
                       principal_category("product_category_name", groups))
    return natural_join(natural_join(items, pt, "product_id"), payments, "order_id")


# -- M3 / M4 ----------------------------------------------------------------
def arrival_by_city(m1: DataFrame, digits: int | None = None) -> DataFrame:
    """M3: mean arrival days and review score per city, rows with a NULL
    mean dropped."""
    g = group_mean(m1, ["customer_city"], ["arrival_days", "review_score"], digits)
    return g.where(F.col("arrival_days").isNotNull() & F.col("review_score").isNotNull())


def arrival_by_state(m1: DataFrame, digits: int | None = None) -> DataFrame:
    """M4: mean arrival days and review score per state name."""
    return group_mean(m1, ["name"], ["arrival_days", "review_score"], digits)


# -- M5 ---------------------------------------------------------------------
def orders_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """M5: one row per order x payment with the value and a month label."""
    o = orders.select("customer_id", "order_id", "order_purchase_timestamp")
    p = payments.select("order_id", "payment_value")
    j = as_timestamp(natural_join(o, p, "order_id"), ["order_purchase_timestamp"], strict=True)
    return j.select("customer_id", F.col("order_purchase_timestamp").alias("order_date"),
                    "order_id", F.col("payment_value").alias("order_value"),
                    month_label("order_purchase_timestamp").alias("month_yr"))


# -- M6 / M7 / M8 / M9 ------------------------------------------------------
def qualified_leads(leads: DataFrame, closed_deals: DataFrame) -> DataFrame:
    """M6: leads that closed a deal."""
    l = leads.select("mql_id", "landing_page_id", "origin")
    d = closed_deals.select("mql_id", "seller_id", "business_segment", "lead_type",
                            "lead_behaviour_profile", "business_type")
    return natural_join(l, d, "mql_id").select(*QUALIFIED_LEAD_COLUMNS)


def seller_sales(items: DataFrame) -> DataFrame:
    """A1: total item price per seller (aggregated before any join, O3)."""
    return group_sum(items.select("seller_id", "price"), ["seller_id"], "price", "seller_sales")


def seller_cltv(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """M7: sales per seller with the seller's location."""
    s = natural_join(seller_sales(items), sellers, "seller_id")
    return s.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
                    F.col("seller_sales").alias("cltv"))


def lead_cltv(leads_mart: DataFrame, items: DataFrame, paid_search_price: float = 0.0,
              paid_origin: str = "paid_search") -> DataFrame:
    """M8: qualified leads with their seller's sales, less an acquisition
    price for one origin (T17; 0 by default as in the source)."""
    j = natural_join(leads_mart, seller_sales(items), "seller_id")
    cols = [c for c in QUALIFIED_LEAD_COLUMNS]
    return j.select(*cols, paid_search_adjusted("seller_sales", "origin", paid_search_price,
                                                paid_origin).alias("cltv"))


def closed_deals(deals: DataFrame) -> DataFrame:
    """M9: the closed deals projected to their ten columns (pruned scan)."""
    return deals.select(*CLOSED_DEAL_COLUMNS)


# -- M10 --------------------------------------------------------------------
def on_time_by_month(m1: DataFrame, month_source: str = "order_delivered_customer_date",
                     year_source: str = "order_approved_at") -> DataFrame:
    """Share of deliveries before / not before the estimate, in
    percent, per (year of approval, month of delivery) (T12).

    arrival = floor days purchase -> delivered; estimate = floor days
    approved -> estimated; rows need all five timestamps and a status.
    """
    rows = as_timestamp(m1, ORDER_TIMESTAMPS)
    complete = F.col("order_status").isNotNull()
    for c in ORDER_TIMESTAMPS:
        complete = complete & F.col(c).isNotNull()
    rows = rows.where(complete)
    arrival = elapsed_days("order_purchase_timestamp", "order_delivered_customer_date")
    estimate = elapsed_days("order_approved_at", "order_estimated_delivery_date")
    kpi = delivered_on_time(arrival, estimate)
    flags = rows.select(F.year(year_source).alias("year"), F.month(month_source).alias("month"),
                        (kpi == "at time").cast("int").alias("at_time"),
                        (kpi == "no").cast("int").alias("no_at_time"))
    out = share_pct(flags, ["year", "month"], ["at_time", "no_at_time"])
    out = out.withColumns({"year": F.col("year").cast("string"),
                           "month": F.col("month").cast("string")})
    return with_period(out)


# -- M11 / M12 --------------------------------------------------------------
def leads_by_month_origin(leads: DataFrame) -> DataFrame:
    """Leads per (year, month of first contact, origin)."""
    l = as_timestamp(leads, ["first_contact_date"])
    l = l.select(F.year("first_contact_date").alias("year"),
                 F.month("first_contact_date").alias("month"), "origin")
    out = count_non_null(l, ["year", "month", "origin"], "origin", "count")
    out = out.withColumns({"year": F.col("year").cast("string"),
                           "month": F.col("month").cast("string")})
    return with_period(out)


def leads_by_origin(leads: DataFrame) -> DataFrame:
    """Leads per origin, largest first."""
    return value_counts(leads.select("origin"), "origin", "count")


# -- M13 --------------------------------------------------------------------
def geolocation(geo: DataFrame, lat: str = "geolocation_lat",
                lng: str = "geolocation_lng") -> DataFrame:
    """Input columns plus ``location`` = 'lat,lng' text."""
    return geo.withColumn("location", location_key(lat, lng))


# -- M14 --------------------------------------------------------------------
def order_rows_by_month(m1: DataFrame, m2: DataFrame) -> DataFrame:
    """For each order and (year, month) of approval, the number of
    non-NULL product ids in m1 x m2 joined on order id.

    The count over the join equals (m1 rows of the order) x (m2 rows of the
    order with a product id), so both sides are counted per order first and
    only the counts are joined: the review x item x payment fan-out is never
    materialised.
    """
    left = as_timestamp(m1, ["order_approved_at"]).where(F.col("order_approved_at").isNotNull())
    left = left.groupBy("order_id", F.year("order_approved_at").alias("year"),
                        F.month("order_approved_at").alias("month")).agg(
        F.count(F.lit(1)).alias("__left_rows"))
    right = m2.groupBy("order_id").agg(F.count("product_id").alias("__right_products"))
    j = natural_join(left, right, "order_id")
    out = j.select("order_id", F.col("year").cast("string").alias("year"),
                   F.col("month").cast("string").alias("month"),
                   (F.col("__left_rows") * F.col("__right_products")).alias("product_id"))
    return with_period(out)


# -- M15 / M16 / rules ------------------------------------------------------
RECOMMENDER_COLUMNS = ["product_id", "product_category_name", "price", "review_score",
                       "customer_id", "order_id"]


def recommender_rows(items: DataFrame, products: DataFrame, reviews: DataFrame,
                     orders: DataFrame) -> DataFrame:
    """J10 + P10: items x products x reviews x orders with the six used
    columns all present. Written as inner joins: the original's full outer
    joins followed by dropping incomplete rows give the same rows (O4)."""
    j = natural_join(items.select("order_id", "product_id", "price"),
                     products.select("product_id", "product_category_name"), "product_id")
    j = natural_join(j, reviews.select("order_id", "review_score"), "order_id")
    j = natural_join(j, orders.select("order_id", "customer_id"), "order_id")
    complete = None
    for c in RECOMMENDER_COLUMNS:
        cond = F.col(c).isNotNull()
        complete = cond if complete is None else complete & cond
    return j.where(complete).select(*RECOMMENDER_COLUMNS)


def ratings(rows: DataFrame) -> DataFrame:
    """Mean review score per (customer, product) for customers with
    more than one row."""
    return user_product_ratings(rows, "customer_id", "product_id", "review_score", min_rows=2)


def basket_rules(rows: DataFrame, min_support: float = 0.00003, min_confidence: float = 0.1,
                 min_lift: float = 1.0) -> DataFrame:
    """R1 + R2: product baskets per order and their association rules, with any
    number of products on either side."""
    b = baskets(rows, "order_id", "product_id")
    return lattice_rules(b, "items", min_support, min_confidence, min_lift)


def recommendations(ratings_df: DataFrame, requests: DataFrame, k: int = 5, n: int = 5,
                    fallback: Sequence = FALLBACK_PRODUCTS, serve_only_requests: bool = False) -> DataFrame:
    """K neighbours -> n products per requested customer, fallback list
    for customers the ratings table cannot serve. ``serve_only_requests``
    computes neighbours for the requested customers only (work linear in
    the ratings; use it for small request sets)."""
    targets = requests if serve_only_requests else None
    # neighbours (customers x k rows) are read several times below: one table
    nb = stored(similar_users(ratings_df, k, "customer_id", "product_id", "rating", targets=targets), "neighbours")
    recs = recommend(ratings_df, nb, n, "customer_id", "product_id", "rating")
    return recommend_or_default(requests, recs, fallback, n, "customer_id", "product_id")


# -- M17 --------------------------------------------------------------------
def sentiments(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Sentiment class per review (text, else score); ``lexicon``: a
    (word, weight) table of any size. A review is its (review, order) pair."""
    return review_sentiment(reviews, "review_comment_title", "review_comment_message",
                            "review_score", lexicon, ["review_id", "order_id"])
