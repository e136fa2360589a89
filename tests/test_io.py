"""Sources and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from bazaar.plans import etl
from bazaar.session import shared_dir, stored
from bazaar.sources import dimensions as D
from bazaar.sources.io import load_ratings, read_table, save_ratings, write_mart
from tests.fixtures import write_raw


def test_read_prunes_columns(spark, tmp_dir):
    write_raw(tmp_dir)
    df = read_table(spark, tmp_dir, "orders", columns=["order_id", "customer_id"])
    assert df.columns == ["order_id", "customer_id"] and df.count() == 6


def test_write_mart_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("2018", "1", 50.0, 50.0)], "year string, month string, at_time double, no_at_time double")
    path = write_mart(df, tmp_dir, "punctuality", fmt="csv", rename={"at_time": "at time", "no_at_time": "no at time"})
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["year", "month", "at time", "no at time"]
    assert back.first()["at time"] == "50.0"


def test_write_mart_parquet_partitioned(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "origin string, n int")
    path = write_mart(df, tmp_dir, "counts", partition_by=["origin"])
    assert {"origin=a", "origin=b"} <= set(os.listdir(path))
    assert spark.read.parquet(path).where(F.col("origin") == "b").first()["n"] == 2


def test_ratings_store(spark, tmp_dir):
    df = spark.createDataFrame([(1, 10, 4.0), (2, 10, 3.0), (1, 11, 5.0)],
                               "customer_id long, product_id long, rating double")
    path = save_ratings(df, os.path.join(tmp_dir, "ratings"), partitions=2)
    assert load_ratings(spark, path).count() == 3
    assert {r.product_id for r in load_ratings(spark, path, users=[1]).collect()} == {10, 11}


def test_translation_dimension(spark):
    t = D.category_translation(spark)
    assert t.count() == 71
    assert t.where("product_category_name = 'beleza_saude'").first()[1] == "health_beauty"


def test_stored_table(spark):
    df = stored(spark.range(10).withColumn("x", F.col("id") * 2), "test")
    assert df.agg(F.sum("x")).first()[0] == 90
    assert all(f.startswith(shared_dir(spark)) or shared_dir(spark).split(":", 1)[-1] in f for f in df.inputFiles())
    assert stored(spark.range(0), "empty").count() == 0


def _file(folder, name, text):
    with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as f:
        f.write(text)


def test_columns_are_found_by_name(spark, tmp_dir):
    _file(tmp_dir, "order_payments", "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                                     "o1,1,credit_card,3,99.5\n")
    row = read_table(spark, tmp_dir, "order_payments").first()
    assert row["payment_value"] == 99.5 and row["payment_type"] == "credit_card"
    assert read_table(spark, tmp_dir, "order_payments", columns=["order_id", "payment_value"]).first() == ("o1", 99.5)
    _file(tmp_dir, "state_codes", "subdivision,category,parent,name\nSP,state,BR,São Paulo\n")
    assert read_table(spark, tmp_dir, "state_codes").first()["name"] == "São Paulo"
    _file(tmp_dir, "closed_deals", "business_type,mql_id,seller_id,sdr_id,sr_id,won_date,business_segment,lead_type,"
                                   "lead_behaviour_profile,has_company,declared_monthly_revenue\n"
                                   "reseller,m1,s1,a,b,2018-01-01 00:00:00,pet,online_big,cat,,10.5\n")
    row = read_table(spark, tmp_dir, "closed_deals").first()
    assert (row["business_type"], row["mql_id"], row["declared_monthly_revenue"], row["has_company"]) == ("reseller", "m1", 10.5, None)


def test_lacking_columns_and_bad_values_raise(spark, tmp_dir):
    _file(tmp_dir, "order_payments", "order_id,payment_type\no1,x\n")
    with pytest.raises(ValueError, match="payment_value"):
        read_table(spark, tmp_dir, "order_payments")
    assert read_table(spark, tmp_dir, "order_payments", columns=["order_id"]).first()[0] == "o1"
    _file(tmp_dir, "sellers", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,not a number,c,SP\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_table(spark, tmp_dir, "sellers").collect()


def test_further_columns_pass_through_to_the_marts(spark, tmp_dir):
    write_raw(tmp_dir)
    for name, column in (("products", "product_weight_g"), ("geolocation", "geolocation_source")):
        path = os.path.join(tmp_dir, f"{name}.csv")
        lines = open(path, encoding="utf-8-sig").read().strip().splitlines()
        _file(tmp_dir, name, "\n".join([f"{column},{lines[0]}"] + [f"w{i},{x}" for i, x in enumerate(lines[1:])]) + "\n")
    out = etl.run_marts(spark, tmp_dir, os.path.join(tmp_dir, "mart"), state_codes=None)
    assert "product_weight_g" in spark.read.parquet(out["order_products_payments"]).columns
    assert "geolocation_source" in spark.read.parquet(out["geolocation"]).columns


def test_plain_files_are_split(spark, tmp_dir):
    _file(tmp_dir, "leads", "mql_id,first_contact_date,landing_page_id,origin\n" + "m,2018-01-01,l,paid_search\n" * 100_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        df = read_table(spark, tmp_dir, "leads")
        assert df.rdd.getNumPartitions() > 3 and df.count() == 100_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_timestamps_of_csv_marts(spark, tmp_dir):
    path = write_mart(spark.sql("select timestamp'2018-01-02 03:04:05' t"), tmp_dir, "t", fmt="csv")
    assert spark.read.option("header", True).csv(path).first()[0] == "2018-01-02 03:04:05"
