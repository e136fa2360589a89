"""Join helpers: natural-join guard (T4), null-safe keys (T5)."""

import pytest

from bazaar.operators.joins import natural_join, with_group_sum


def test_t4_common_columns_must_be_the_keys(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1, "y")], "id int, name string")
    with pytest.raises(ValueError):
        natural_join(a, b, ["id"])
    assert natural_join(a, b, ["id", "name"]).count() == 0


def test_t5_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    b = spark.createDataFrame([(None, 10), (2, 20)], "k int, b int")
    assert natural_join(a, b, ["k"]).count() == 1                 # SQL: NULL matches nothing
    rows = sorted(natural_join(a, b, ["k"], null_safe=True).collect(), key=lambda r: r.a)
    assert [(r.k, r.a, r.b) for r in rows] == [(None, 1, 10), (2, 2, 20)]


def test_marts_refuse_a_further_common_column(spark):
    from bazaar.plans import marts as M
    items = spark.createDataFrame([("o", "p", "s", 1.0, "x")], "order_id string, product_id string, seller_id string, price double, note string")
    products = spark.createDataFrame([("p", "bebes")], "product_id string, product_category_name string")
    translation = spark.createDataFrame([("bebes", "baby")], "product_category_name string, product_category_name_english string")
    payments = spark.createDataFrame([("o", 2.0, "y")], "order_id string, payment_value double, note string")
    with pytest.raises(ValueError, match="note"):
        M.order_products_payments(items, products, translation, payments)
    out = M.order_products_payments(items.drop("note"), products, translation, payments).first()
    assert out["note"] == "y" and out["product_principal_category"] == "kids"
    with pytest.raises(ValueError, match="seller_sales"):
        M.seller_cltv(items, spark.createDataFrame([("s", 1.0)], "seller_id string, seller_sales double"))


def test_group_sum_of_a_hot_key(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7), (3, 8)], "k long, m long")
    out = with_group_sum(df, "k", "m", F.lit(1), "n")
    assert {(r.k, r.n) for r in out.collect()} == {(1, 500), (2, 1), (3, 1)} and out.count() == 502
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
