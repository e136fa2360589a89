"""Batch runners for the jobs of the store application.

0. ``convert_raw``: raw CSV files -> Parquet, rows that don't fit set aside.
1. ``run_marts``: raw files -> marts M1-M14 (one driver program; the wide
   marts M1 and M2 are written first and read back for M10 and M14, so a
   lost executor recomputes from those files, not from the raw scans).
2. ``build_recommender`` / ``serve_recommendations``: ratings table (S7),
   association rules, then recommendations for a set of customers.
3. ``score_reviews``: sentiment class per review (M17).

Every output is a version of a mart under ``mart_base``, published when it is
whole (``sources.io.publish``); paths are URIs, so the same code writes to an
object store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.plans import marts as M
from bazaar.session import tables_dropped, tune
from bazaar.sources.dimensions import FALLBACK_PRODUCTS, STATE_CODES, category_translation
from bazaar.sources.records import convert
from bazaar.sources.schemas import RAW_SCHEMAS
from bazaar.sources.io import load_ratings, publish, read_published, read_table, save_ratings

# Mart names as the application publishes them.
MART_FILES = {
    "order_reviews": "orders_customers_reviews_pbi",
    "order_products_payments": "order_products_payments",
    "orders_payment": "orders_payment",
    "qualified_leads": "etl_qualified_leads",
    "seller_cltv": "etl_cltv",
    "lead_cltv": "etl_qml_cltv",
    "closed_deals": "closed_deals_dataset",
    "on_time_by_month": "PODTCWTLM",
    "leads_by_month_origin": "CGRATMCCTTPM",
    "leads_by_origin": "CARBO",
    "geolocation": "geolocation",
    "order_rows_by_month": "MAPOPBCWLM",
    "arrival_by_city": "arrival_by_city",
    "arrival_by_state": "arrival_by_state",
}


def convert_raw(spark: SparkSession, raw_base: str, good_base: str, bad_base: str, names: Sequence[str] = tuple(RAW_SCHEMAS),
                most_bad: float = 0.001) -> dict[str, dict[str, int]]:
    """Raw CSV tables to Parquet under ``good_base``, for the runners below with
    ``raw_fmt="parquet"``; records that don't fit their types to ``bad_base``.
    Files with line breaks in quoted fields are split among tasks. Returns the
    numbers of rows; a share of bad rows above ``most_bad`` raises."""
    tune(spark)
    out = {}
    for name in names:
        with tables_dropped(spark):
            out[name] = convert(spark, raw_base, name, f"{good_base.rstrip('/')}/{name}.parquet",
                                f"{bad_base.rstrip('/')}/{name}", most_bad)
    return out


def run_marts(spark: SparkSession, raw_base: str, mart_base: str, raw_fmt: str = "csv",
              out_fmt: str = "parquet", paid_search_price: float = 0.0,
              state_codes: Sequence[str] | None = STATE_CODES) -> dict[str, str]:
    """Build and write marts M1-M14; returns {mart: path}.

    ``state_codes`` keeps only those subdivisions of the state-name table, by
    default the country's 27 states, as the source does; None keeps all.
    """
    tune(spark)

    def raw(name: str, cols: list[str] | None = None) -> DataFrame:
        return read_table(spark, raw_base, name, fmt=raw_fmt, columns=cols)

    def write(key: str, df: DataFrame) -> str:
        rename = {k: v for k, v in M.EXPORT_NAMES.items() if k in df.columns} if out_fmt == "csv" else None
        return publish(df, mart_base, MART_FILES[key], fmt=out_fmt, rename=rename)

    def read_back(key: str) -> DataFrame:
        """A written mart as the next job's input (lineage cut at the files)."""
        df = read_published(spark, mart_base, MART_FILES[key])
        return df.withColumnsRenamed({v: k for k, v in M.EXPORT_NAMES.items() if v in df.columns}) if out_fmt == "csv" else df

    out: dict[str, str] = {}
    states = raw("state_codes")
    if state_codes is not None:
        states = states.where(F.col("subdivision").isin(list(state_codes)))
    items = raw("order_items")

    out["order_reviews"] = write("order_reviews", M.order_reviews(
        raw("orders"), raw("customers"), states, raw("order_reviews")))
    out["order_products_payments"] = write("order_products_payments", M.order_products_payments(
        items, raw("products"), category_translation(spark), raw("order_payments")))
    m1, m2 = read_back("order_reviews"), read_back("order_products_payments")

    out["arrival_by_city"] = write("arrival_by_city", M.arrival_by_city(m1))
    out["arrival_by_state"] = write("arrival_by_state", M.arrival_by_state(m1))
    out["orders_payment"] = write("orders_payment", M.orders_payment(
        raw("orders", ["customer_id", "order_id", "order_purchase_timestamp"]),
        raw("order_payments", ["order_id", "payment_value"])))
    out["qualified_leads"] = write("qualified_leads", M.qualified_leads(
        raw("leads", ["mql_id", "landing_page_id", "origin"]), raw("closed_deals")))
    out["seller_cltv"] = write("seller_cltv", M.seller_cltv(items, raw("sellers")))
    out["lead_cltv"] = write("lead_cltv", M.lead_cltv(
        read_back("qualified_leads"), items, paid_search_price))
    out["closed_deals"] = write("closed_deals", M.closed_deals(raw("closed_deals")))
    out["on_time_by_month"] = write("on_time_by_month", M.on_time_by_month(m1))
    leads = raw("leads")
    out["leads_by_month_origin"] = write("leads_by_month_origin", M.leads_by_month_origin(leads))
    out["leads_by_origin"] = write("leads_by_origin", M.leads_by_origin(leads))
    out["geolocation"] = write("geolocation", M.geolocation(raw("geolocation")))
    out["order_rows_by_month"] = write("order_rows_by_month", M.order_rows_by_month(m1, m2))
    return out


def build_recommender(spark: SparkSession, raw_base: str, model_base: str, raw_fmt: str = "csv",
                      min_support: float = 0.00003, min_confidence: float = 0.1,
                      min_lift: float = 1.0) -> dict[str, str]:
    """M15 + rules: the ratings table (S7) and the association rules."""
    tune(spark)

    def raw(name: str) -> DataFrame:
        return read_table(spark, raw_base, name, fmt=raw_fmt)

    rows = M.recommender_rows(raw("order_items"), raw("products"), raw("order_reviews"), raw("orders"))
    ratings_path = save_ratings(M.ratings(rows), f"{model_base.rstrip('/')}/ratings")
    with tables_dropped(spark):
        rules = M.basket_rules(rows, min_support, min_confidence, min_lift)
        rules_path = publish(rules, model_base, "association_rules")
    return {"ratings": ratings_path, "association_rules": rules_path}


def serve_recommendations(spark: SparkSession, model_base: str, requests: DataFrame,
                          k: int = 5, n: int = 5, fallback: Sequence = FALLBACK_PRODUCTS,
                          serve_only_requests: bool = True) -> DataFrame:
    """M16 for the requested customers (work linear in the ratings when
    ``serve_only_requests``)."""
    tune(spark)
    ratings = load_ratings(spark, f"{model_base.rstrip('/')}/ratings")
    return M.recommendations(ratings, requests, k, n, fallback, serve_only_requests)


def score_reviews(spark: SparkSession, raw_base: str, mart_base: str,
                  lexicon: DataFrame, raw_fmt: str = "csv") -> str:
    """Sentiment per review, written as a mart; ``lexicon``: (word, weight)."""
    tune(spark)
    reviews = read_table(spark, raw_base, "order_reviews", fmt=raw_fmt)
    with tables_dropped(spark):
        return publish(M.sentiments(reviews, lexicon), mart_base, "review_sentiments")
