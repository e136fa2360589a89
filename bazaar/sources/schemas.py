"""Types of the raw store files' columns, by name (no inference on read).
A file may hold its columns in any order, and further ones.

Timestamps are declared as text: the marts parse them with a ``try_cast``
so that an unparseable value becomes NULL instead of failing the scan (T2).
Zip prefixes are integers, as the source reads them (leading zeros are lost,
T20).
"""

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS = {
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", S), ("order_approved_at", S),
        ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
        ("order_estimated_delivery_date", S)),
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
        ("customer_city", S), ("customer_state", S)),
    "state_codes": _schema(("subdivision", S), ("name", S)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", S), ("review_answer_timestamp", S)),
    "products": _schema(("product_id", S), ("product_category_name", S)),
    "category_translation": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", S), ("price", D), ("freight_value", D)),
    "order_payments": _schema(("order_id", S), ("payment_value", D)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S),
        ("seller_state", S)),
    "leads": _schema(
        ("mql_id", S), ("first_contact_date", S), ("landing_page_id", S), ("origin", S)),
    "closed_deals": _schema(
        ("mql_id", S), ("seller_id", S), ("sdr_id", S), ("sr_id", S), ("won_date", S),
        ("business_segment", S), ("lead_type", S), ("lead_behaviour_profile", S),
        ("business_type", S), ("declared_monthly_revenue", D)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
}

# Tables whose quoted fields may hold line breaks (free text).
MULTI_LINE = {"order_reviews"}

# Column names of the closed-deals mart (M9) and qualified-leads mart (M6).
CLOSED_DEAL_COLUMNS = [f.name for f in RAW_SCHEMAS["closed_deals"].fields]
QUALIFIED_LEAD_COLUMNS = [
    "landing_page_id", "origin", "seller_id", "business_segment", "lead_type",
    "lead_behaviour_profile", "business_type",
]
