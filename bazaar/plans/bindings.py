"""Operators bound to the driver's test tables (``/root/testdata/sf*/``).

The store schema has no counterpart in the test tables, so each binding is
a projection of whole test tables into store column names (documented per
view) followed by the library operator itself. Every query reads the whole
tables it names; no row is filtered out to make a check cheaper.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.functions.columns import (
    elapsed_days, order_status_code, principal_category, review_score_class,
)
from bazaar.functions.text import clean_text
from bazaar.operators.rules import association_rules, baskets, lattice_rules, pair_rules
from bazaar.operators.neighbours import (
    recommend, recommend_or_default, refreshed_neighbours, similar_users, similar_users_by_index, user_product_ratings,
)
from bazaar.operators.rating_sums import merge_ratings, ratings_of, read_sums
from bazaar.operators.lexicon import learn_lexicon, lexicon_polarity, review_sentiment, sentiment
from bazaar.plans import etl, marts
from bazaar.session import shared_dir, stored, tune
from bazaar.sources.io import CSV_TIMESTAMP, load_ratings, read_published, read_table, save_ratings, save_ratings_table
from bazaar.sources.records import convert

# ---------------------------------------------------------------------------
# Binding parameters (fixed values of the test bindings, not of the store).
# Status letters of the test orders mapped to store labels; 'P' keeps its
# letter and so gets code 0.
STATUS_LABEL = {"F": "delivered", "O": "shipped"}
# Part types grouped into two principal categories; other types -> '0'.
PART_TYPE_GROUPS = {"budget": ["ECONOMY", "PROMO"], "size": ["SMALL", "MEDIUM", "LARGE"]}
# Acquisition price subtracted from one lead origin in the lead CLTV binding.
PAID_ORIGIN, PAID_PRICE = "MACHINERY", 100.0
# Rule-mining thresholds for the test baskets.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.0002, 0.05, 1.0
# The same for baskets of part types, which give rules of several items.
TYPE_SUPPORT, TYPE_CONFIDENCE, TYPE_LIFT = 0.02, 0.1, 0.5
# Neighbours and products per user.
K_NEIGHBOURS, N_PRODUCTS = 5, 5
# Block size of the query that takes the path of hot keys.
SMALL_BLOCK = 8
# Raters from which a product is hot in the query that takes that path.
SMALL_HOT = 32
# Buckets of the ratings table and parts of the rating sums.
BUCKETS = 8
# Rows of a compressed raw CSV file.
CSV_FILE_ROWS = 500_000
# Polarity lexicon for the test corpus: frequent words with weights that are
# multiples of 1/64 (sums are exact, so every engine agrees on the classes).
TEST_LEXICON = {
    "the": 0.046875, "of": -0.109375, "and": 0.34375, "to": 0.203125, "in": -0.296875,
    "la": 0.5, "der": -0.59375, "is": 0.3125, "that": -0.1875, "en": 0.40625,
    "it": 0.09375, "for": 0.609375, "was": -0.40625, "die": -0.796875, "with": 0.703125,
    "le": 0.25, "und": 0.453125, "el": -0.5, "les": 0.15625, "this": -0.046875,
}
# Folds of the labelled documents, and the least number of reviews of a learned word.
FOLDS, LEXICON_LEAST = 5, 5
DIGITS = 6  # computed doubles are rounded to this many decimals for the value hash




def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEST_LEXICON.items()), "word string, weight double")


def _status_label(col: str = "o_orderstatus"):
    expr = None
    for letter, label in STATUS_LABEL.items():
        c = F.col(col) == letter
        expr = F.when(c, F.lit(label)) if expr is None else expr.when(c, F.lit(label))
    return expr.otherwise(F.col(col))


# -- views of the test tables in store column names ---------------------------
def orders_view(spark, d) -> DataFrame:
    """orders: purchase = order date; approved = order date unless status
    'P' (NULL); carrier = order date; delivered = last ship date of the
    order's items (NULL without items); estimate = order date + 60 days."""
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    last_ship = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("delivered"))
    return o.join(last_ship, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        _status_label().alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("order_approved_at"),
        F.col("o_orderdate").alias("order_delivered_carrier_date"),
        F.col("delivered").alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(60), F.col("o_orderdate")).alias("order_estimated_delivery_date"))


def customers_view(spark, d) -> DataFrame:
    """customers: unique id = name, zip = nation key, city = market
    segment, state = nation key as text."""
    c = _t(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_unique_id"),
                    F.col("c_nationkey").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("c_nationkey").cast("string").alias("customer_state"))


def state_codes_view(spark, d) -> DataFrame:
    n = _t(spark, d, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("subdivision"),
                    F.col("n_name").alias("name"))


def reviews_view(spark, d) -> DataFrame:
    """reviews: one per line item; score = 1 + line number mod 5."""
    l = _t(spark, d, "lineitem")
    return l.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
                    ).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_linenumber") % 5).alias("review_score"),
        F.col("l_returnflag").alias("review_comment_title"),
        F.col("l_linestatus").alias("review_comment_message"),
        F.col("l_shipdate").alias("review_creation_date"),
        F.col("l_shipdate").alias("review_answer_timestamp"))


def items_view(spark, d) -> DataFrame:
    l = _t(spark, d, "lineitem")
    return l.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
                    F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
                    F.col("l_shipdate").alias("shipping_limit_date"),
                    F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("freight_value"))


def products_view(spark, d) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"))


def translation_view(spark, d) -> DataFrame:
    """translation: each part type to its lower-case form."""
    p = _t(spark, d, "part")
    return p.select(F.col("p_type").alias("product_category_name")).distinct().withColumn(
        "product_category_name_english", F.lower("product_category_name"))


def payments_view(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("payment_value"))


def sellers_view(spark, d) -> DataFrame:
    s, n = _t(spark, d, "supplier"), _t(spark, d, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"), F.col("n_name").alias("seller_state"))


def leads_view(spark, d) -> DataFrame:
    """leads: customers; landing page = name, origin = market segment."""
    c = _t(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("mql_id"), F.lit(None).cast("timestamp").alias("first_contact_date"),
                    F.col("c_name").alias("landing_page_id"), F.col("c_mktsegment").alias("origin"))


def closed_deals_view(spark, d) -> DataFrame:
    """closed deals: suppliers (lead id = seller id = supplier key) with
    nation and region names; no won date or behaviour profile."""
    s, n, r = _t(spark, d, "supplier"), _t(spark, d, "nation"), _t(spark, d, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(
        F.col("s_suppkey").alias("mql_id"), F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("sdr_id"),
        F.col("n_regionkey").cast("string").alias("sr_id"),
        F.lit(None).cast("timestamp").alias("won_date"), F.col("n_name").alias("business_segment"),
        F.col("s_name").alias("lead_type"), F.lit(None).cast("string").alias("lead_behaviour_profile"),
        F.col("r_name").alias("business_type"), F.col("s_acctbal").alias("declared_monthly_revenue"))


def order_lines_view(spark, d) -> DataFrame:
    """Order rows at line grain for the punctuality mart: purchase = order
    date + 3 h x line number (so elapsed days are not calendar days),
    approved = order date unless status 'P', delivered = ship date,
    estimate = order date + 60 days."""
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.timestamp_add("HOUR", F.col("l_linenumber") * 3, F.col("o_orderdate")).alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("order_approved_at"),
        F.col("o_orderdate").alias("order_delivered_carrier_date"),
        F.col("l_shipdate").alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(60), F.col("o_orderdate")).alias("order_estimated_delivery_date"))


def rating_rows_view(spark, d) -> DataFrame:
    """Recommender rows: customer of the order, part, quantity as score."""
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("review_score"), F.col("l_orderkey").alias("order_id"))


def _round(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# -- queries -------------------------------------------------------------------
def q_on_time_by_month(spark, d):
    tune(spark)
    return marts.on_time_by_month(order_lines_view(spark, d))


def q_elapsed_days(spark, d):
    tune(spark)
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    start = F.timestamp_add("HOUR", F.col("l_linenumber") * 3, F.col("o_orderdate"))
    return j.select("l_orderkey", "l_linenumber", elapsed_days(start, "l_shipdate").alias("elapsed_days"))


def q_orders_payment(spark, d):
    tune(spark)
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"),
                                      F.col("o_orderkey").alias("order_id"),
                                      F.col("o_orderdate").alias("order_purchase_timestamp"))
    p = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                        F.col("l_extendedprice").alias("payment_value"))
    return marts.orders_payment(o, p)


def q_qualified_leads(spark, d):
    tune(spark)
    return marts.qualified_leads(leads_view(spark, d), closed_deals_view(spark, d))


def q_seller_cltv(spark, d):
    tune(spark)
    return _round(marts.seller_cltv(items_view(spark, d), sellers_view(spark, d)), ["cltv"], 2)


def q_lead_cltv(spark, d):
    tune(spark)
    ql = marts.qualified_leads(leads_view(spark, d), closed_deals_view(spark, d))
    out = marts.lead_cltv(ql, items_view(spark, d), PAID_PRICE, PAID_ORIGIN)
    return _round(out, ["cltv"], 2)


def q_closed_deals(spark, d):
    tune(spark)
    return marts.closed_deals(closed_deals_view(spark, d))


def q_leads_by_month_origin(spark, d):
    tune(spark)
    o = _t(spark, d, "orders").select(F.col("o_orderdate").alias("first_contact_date"),
                                      F.col("o_orderpriority").alias("origin"))
    return marts.leads_by_month_origin(o)


def q_leads_by_origin(spark, d):
    tune(spark)
    e = _t(spark, d, "events").select(F.col("event_type").alias("origin"))
    return marts.leads_by_origin(e)


def q_geolocation(spark, d):
    tune(spark)
    c = _t(spark, d, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("geolocation_lat"),
        F.col("c_nationkey").cast("double").alias("geolocation_lng"))
    return marts.geolocation(c)


def _m1(spark, d):
    return marts.order_reviews(orders_view(spark, d), customers_view(spark, d),
                               state_codes_view(spark, d), reviews_view(spark, d))


def _m2(spark, d):
    return marts.order_products_payments(items_view(spark, d), products_view(spark, d),
                                         translation_view(spark, d), payments_view(spark, d),
                                         PART_TYPE_GROUPS)


def q_order_reviews(spark, d):
    tune(spark)
    return _m1(spark, d)


def q_order_products_payments(spark, d):
    tune(spark)
    return _m2(spark, d)


def q_arrival_by_city(spark, d):
    tune(spark)
    return marts.arrival_by_city(_m1(spark, d), DIGITS)


def q_arrival_by_state(spark, d):
    tune(spark)
    return marts.arrival_by_state(_m1(spark, d), DIGITS)


def q_order_rows_by_month(spark, d):
    tune(spark)
    return marts.order_rows_by_month(_m1(spark, d), _m2(spark, d))


def q_order_status_code(spark, d):
    tune(spark)
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                      _status_label().alias("order_status"))
    return o.withColumn("numeric_order_status", order_status_code("order_status"))


def q_principal_category(spark, d):
    tune(spark)
    p = _t(spark, d, "part").select("p_partkey", "p_type")
    return p.withColumn("product_principal_category", principal_category("p_type", PART_TYPE_GROUPS))


def q_baskets(spark, d):
    tune(spark)
    b = baskets(_t(spark, d, "lineitem"), "l_orderkey", "l_partkey")
    return b.select(F.col("l_orderkey").alias("order_id"),
                    F.array_join(F.col("items").cast("array<string>"), " ").alias("items"),
                    F.size("items").alias("n_items"))


def q_pair_rules(spark, d):
    tune(spark)
    return pair_rules(_t(spark, d, "lineitem"), "l_orderkey", "l_partkey",
                      MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, digits=DIGITS)


def q_association_rules(spark, d):
    tune(spark)
    b = baskets(_t(spark, d, "lineitem"), "l_orderkey", "l_partkey")
    r = association_rules(b, "items", MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, digits=DIGITS)
    return r.select(F.array_join(F.col("antecedent").cast("array<string>"), " ").alias("antecedent"),
                    F.array_join(F.col("consequent").cast("array<string>"), " ").alias("consequent"),
                    "support", "confidence", "lift")


def _typed_baskets(spark, d):
    l, p = _t(spark, d, "lineitem"), _t(spark, d, "part")
    return l.join(p, l.l_partkey == p.p_partkey).select("l_orderkey", "p_type")


def q_type_rules(spark, d):
    """Rules between part types: few items, so rules of several."""
    tune(spark)
    r = association_rules(baskets(_typed_baskets(spark, d), "l_orderkey", "p_type"), "items",
                          TYPE_SUPPORT, TYPE_CONFIDENCE, TYPE_LIFT, digits=DIGITS)
    return r.select(F.array_join("antecedent", " ").alias("antecedent"),
                    F.array_join("consequent", " ").alias("consequent"), "support", "confidence", "lift")


def q_lattice_rules(spark, d):
    """Rules between part types with any number of types on either side."""
    tune(spark)
    r = lattice_rules(baskets(_typed_baskets(spark, d), "l_orderkey", "p_type"), "items",
                      TYPE_SUPPORT, TYPE_CONFIDENCE, TYPE_LIFT, digits=DIGITS)
    return r.select(F.array_join("antecedent", " ").alias("antecedent"),
                    F.array_join("consequent", " ").alias("consequent"), "support", "confidence", "lift")


def q_recommender_rows(spark, d):
    """Items x products x reviews x orders, complete rows only."""
    tune(spark)
    return marts.recommender_rows(items_view(spark, d), products_view(spark, d), reviews_view(spark, d),
                                  orders_view(spark, d))


def _ratings(spark, d):
    return user_product_ratings(rating_rows_view(spark, d), "customer_id", "product_id",
                                "review_score", min_rows=2)


def q_user_product_ratings(spark, d):
    tune(spark)
    return _round(_ratings(spark, d), ["rating"])


def _neighbours(r):
    return similar_users(r, K_NEIGHBOURS, "customer_id", "product_id", "rating")


def q_similar_users(spark, d):
    tune(spark)
    return _round(_neighbours(stored(_ratings(spark, d), "ratings")), ["similarity"])


def q_similar_users_in_blocks(spark, d):
    """The same with products and users cut into small blocks: every product
    of more than ``SMALL_BLOCK`` raters takes the path of a hot key."""
    tune(spark)
    r = stored(_ratings(spark, d), "ratings")
    return _round(similar_users(r, K_NEIGHBOURS, "customer_id", "product_id", "rating",
                                max_block=SMALL_BLOCK), ["similarity"])


def q_similar_users_hot_products(spark, d):
    """The same with every product of more than ``SMALL_HOT`` raters taken as
    hot: only pairs that can reach a top k are formed for it."""
    tune(spark)
    r = stored(_ratings(spark, d), "ratings")
    return _round(similar_users(r, K_NEIGHBOURS, "customer_id", "product_id", "rating",
                                hot_raters=SMALL_HOT), ["similarity"])


def q_similar_users_by_index(spark, d):
    """The same through the index of products: those of more than
    ``SMALL_HOT`` raters are read from the least rated on, up to each user's
    bound."""
    tune(spark)
    r = stored(_ratings(spark, d), "ratings")
    return _round(similar_users_by_index(r, K_NEIGHBOURS, "customer_id", "product_id", "rating",
                                         cold_raters=SMALL_HOT), ["similarity"])


def q_recommend(spark, d):
    tune(spark)
    # ratings and neighbours (users x k rows) feed several jobs: tables
    r = stored(_ratings(spark, d), "ratings")
    nb = stored(_neighbours(r), "neighbours")
    recs = recommend(r, nb, N_PRODUCTS, "customer_id", "product_id", "rating")
    return _round(recs, ["score"])


def popular_products(r: DataFrame, n: int = N_PRODUCTS) -> list:
    """Binding fallback list: the n products with most ratings (ties to the
    smaller id); a top-n report, n values reach the driver."""
    top = (r.groupBy("product_id").agg(F.count(F.lit(1)).alias("c"))
           .orderBy(F.col("c").desc(), F.col("product_id").asc()).limit(n))
    return [row["product_id"] for row in top.collect()]


def q_recommend_or_default(spark, d):
    tune(spark)
    r = stored(_ratings(spark, d), "ratings")
    requests = _t(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    nb = stored(_neighbours(r), "neighbours")
    recs = recommend(r, nb, N_PRODUCTS, "customer_id", "product_id", "rating")
    out = recommend_or_default(requests, recs, popular_products(r), N_PRODUCTS,
                               "customer_id", "product_id")
    return out


def q_clean_text(spark, d):
    tune(spark)
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return clean_text(docs, "text", "clean_text").select("doc_id", "clean_text")


def q_lexicon_polarity(spark, d):
    tune(spark)
    docs = _t(spark, d, "documents").select("doc_id", "text")
    # weights are multiples of 1/64: the sums are exact and the mean is one
    # division, so the value is the same in every engine without rounding
    # (rounding would only add half-way ties at the 7th decimal)
    return lexicon_polarity(docs, "text", _lexicon(spark), "doc_id")


def q_sentiment(spark, d):
    tune(spark)
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return sentiment(docs, "text", _lexicon(spark), "doc_id")


def q_review_score_class(spark, d):
    tune(spark)
    l = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                        (F.col("l_quantity") / 10.0).alias("review_score"))
    return l.withColumn("score_class", review_score_class("review_score"))


def q_review_sentiment(spark, d):
    """Every document is a review: title = source, message = text, score = 1
    or 5 by quality, null where it has no label."""
    tune(spark)
    docs, labels = _t(spark, d, "documents"), _t(spark, d, "labels")
    j = docs.join(labels, "doc_id", "left").select(
        "doc_id", F.col("source").alias("title"), F.col("text").alias("message"),
        (F.lit(1) + F.lit(4) * F.col("quality")).alias("score"))
    return review_sentiment(j, "title", "message", "score", _lexicon(spark), "doc_id")


def q_label_sentiment(spark, d):
    """Every label is a review without title and message: the class is that
    of the score."""
    tune(spark)
    none = F.lit(None).cast("string")
    rows = _t(spark, d, "labels").select("doc_id", none.alias("title"), none.alias("message"),
                                         (F.lit(1) + F.lit(4) * F.col("quality")).alias("score"))
    return review_sentiment(rows, "title", "message", "score", _lexicon(spark), "doc_id")


def _labelled_reviews(spark, d):
    """documents as reviews: score = 1 or 5 by quality, null without a label;
    fold = doc_id mod ``FOLDS``."""
    docs, labels = _t(spark, d, "documents"), _t(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.col("text").alias("message"), F.lit(None).cast("string").alias("title"),
        (F.lit(1) + F.lit(4) * F.col("quality")).alias("score"), F.pmod("doc_id", F.lit(FOLDS)).cast("int").alias("fold"))


def q_learned_lexicon(spark, d):
    """Word weights learned from all labelled documents."""
    tune(spark)
    return learn_lexicon(_labelled_reviews(spark, d), "message", "score", LEXICON_LEAST)


def q_held_out_sentiment(spark, d):
    """X7 of every document by the lexicon that was learned without its fold."""
    tune(spark)
    reviews = _labelled_reviews(spark, d)
    lexicon = stored(learn_lexicon(reviews, "message", "score", LEXICON_LEAST, fold="fold", folds=FOLDS), "lexicons")
    return review_sentiment(reviews, "title", "message", "score", lexicon, "doc_id", fold="fold")


def q_recommend_from_buckets(spark, d):
    """R6 from a ratings table bucketed by user."""
    tune(spark)
    name = f"ratings_{uuid.uuid4().hex}"
    r = save_ratings_table(_ratings(spark, d), name, BUCKETS, path=f"{shared_dir(spark)}/{name}")
    nb = stored(_neighbours(r), "neighbours")
    return _round(recommend(r, nb, N_PRODUCTS, "customer_id", "product_id", "rating", bucketed=True), ["score"])


def q_merged_ratings(spark, d):
    """R4 from sums that were merged in three batches, one of them twice."""
    tune(spark)
    rows = rating_rows_view(spark, d).withColumn("batch", F.pmod(F.xxhash64("order_id"), F.lit(3)))
    path = f"{shared_dir(spark)}/rating-state-{uuid.uuid4().hex}"
    for batch in (0, 1, 1, 2):
        merge_ratings(rows.where(F.col("batch") == batch), path, batch, "customer_id", "product_id", "review_score", BUCKETS)
    return _round(ratings_of(read_sums(spark, path), "customer_id", "product_id"), ["rating"])


def q_refreshed_neighbours(spark, d):
    """R5 after an update, the last order of all: only the neighbours of those
    whom it can concern are computed anew."""
    tune(spark)
    # read three times: joined once
    rows = stored(rating_rows_view(spark, d), "rating-rows")
    last = rows.agg(F.max("order_id")).scalar()
    old = stored(user_product_ratings(rows.where(F.col("order_id") < last), "customer_id", "product_id", "review_score"), "ratings-before")
    new = stored(_ratings(spark, d), "ratings")
    nb = refreshed_neighbours(stored(_neighbours(old), "neighbours-before"), old, new, K_NEIGHBOURS)
    return _round(nb, ["similarity"])


# -- the raw path: test tables written as CSV files, read as a user's are --------
def _csv_folder(spark: SparkSession, tables: dict[str, DataFrame], codec: str = "none", rows: int = 0) -> str:
    """A folder of raw CSV tables, each a folder of part files (of at most
    ``rows`` rows, 0: any number), with texts quoted where they need it and
    timestamps as the store writes them. A compressed file is read by one task."""
    folder = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    for name, df in tables.items():
        (df.write.option("header", True).option("compression", codec).option("maxRecordsPerFile", rows).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("timestampNTZFormat", CSV_TIMESTAMP)
         .option("timestampFormat", CSV_TIMESTAMP).csv(f"{folder}/{name}.csv"))
    return folder


def q_csv_documents(spark, d):
    """Documents, whose texts hold line breaks and quotes, through CSV files
    split among tasks; none may be set aside."""
    tune(spark)
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    folder = _csv_folder(spark, {"documents": docs})
    convert(spark, folder, "documents", f"{folder}/good", f"{folder}/bad", 0.0, docs.schema, multi_line=True)
    return spark.read.schema(docs.schema).parquet(f"{folder}/good")


def q_csv_orders_payment(spark, d):
    """M5 from CSV files, pruned by header name, with timestamps
    parsed strictly."""
    tune(spark)
    payments = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("payment_value"))
    folder = _csv_folder(spark, {"orders": orders_view(spark, d), "order_payments": payments})
    return marts.orders_payment(
        read_table(spark, folder, "orders", columns=["customer_id", "order_id", "order_purchase_timestamp"]),
        read_table(spark, folder, "order_payments", columns=["order_id", "payment_value"]))


def q_csv_marts(spark, d):
    """The whole mart batch from CSV files; of its published
    marts the delivery punctuality by month (M10), which is made from M1."""
    tune(spark)
    geolocation = _t(spark, d, "customer").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"), F.col("c_acctbal").alias("geolocation_lat"),
        F.col("c_nationkey").cast("double").alias("geolocation_lng"), F.col("c_mktsegment").alias("geolocation_city"),
        F.col("c_nationkey").cast("string").alias("geolocation_state"))
    folder = _csv_folder(spark, {
        "orders": orders_view(spark, d), "customers": customers_view(spark, d), "state_codes": state_codes_view(spark, d),
        "order_reviews": reviews_view(spark, d), "order_items": items_view(spark, d), "products": products_view(spark, d),
        "order_payments": payments_view(spark, d), "sellers": sellers_view(spark, d), "leads": leads_view(spark, d),
        "closed_deals": closed_deals_view(spark, d), "geolocation": geolocation}, "gzip", CSV_FILE_ROWS)
    etl.run_marts(spark, folder, f"{folder}/marts", state_codes=None)
    return read_published(spark, f"{folder}/marts", etl.MART_FILES["on_time_by_month"])


def q_ratings_store(spark, d):
    """The ratings table saved and loaded."""
    tune(spark)
    path = save_ratings(_ratings(spark, d), f"{shared_dir(spark)}/ratings-store-{uuid.uuid4().hex}")
    return _round(load_ratings(spark, path), ["rating"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
