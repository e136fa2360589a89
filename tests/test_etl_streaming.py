"""Batch runner and streaming upkeep on the CSV fixtures."""

import os

from bazaar.plans import etl
from bazaar.plans.marts import sentiments
from bazaar.sources.io import read_published, read_table
from bazaar.sources.schemas import RAW_SCHEMAS
from bazaar.streaming import stream_lead_counts, stream_review_sentiments
from tests.fixtures import CSV, write_raw

LEX = {"bom": 0.5, "ruim": -0.75}


def test_run_marts_end_to_end(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    write_raw(raw)
    out = etl.run_marts(spark, raw, os.path.join(tmp_dir, "mart"), state_codes=["SP", "RJ"])
    assert set(out) == set(etl.MART_FILES)
    counts = {k: spark.read.parquet(p).count() for k, p in out.items()}
    assert counts["order_reviews"] == 6 and counts["order_rows_by_month"] == 4
    assert counts["on_time_by_month"] == 3 and counts["seller_cltv"] == 3


def test_run_marts_csv_export(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    write_raw(raw)
    out = etl.run_marts(spark, raw, os.path.join(tmp_dir, "csv"), out_fmt="csv", state_codes=["SP", "RJ"])
    read = lambda k: spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out[k])
    assert "Arrival time (In Days)" in read("order_reviews").columns
    assert read("on_time_by_month").columns == ["year", "month", "at time", "no at time", "first", "last"]
    assert read("order_rows_by_month").count() == 4 and read("on_time_by_month").count() == 3


def test_recommender_build_and_serve(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    write_raw(raw)
    paths = etl.build_recommender(spark, raw, os.path.join(tmp_dir, "model"), min_support=0.1)
    assert spark.read.parquet(paths["ratings"]).count() > 0
    req = spark.createDataFrame([("c1",), ("nobody",)], "customer_id string")
    recs = etl.serve_recommendations(spark, os.path.join(tmp_dir, "model"), req)
    rows = {r.customer_id: r.is_default for r in recs.collect()}
    assert rows["nobody"] is True


def test_streaming_lead_counts(spark, tmp_dir):
    src, mart, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "mart", "ckpt"))
    os.makedirs(src)
    lines = CSV["leads"].strip().splitlines()
    with open(os.path.join(src, "part1.csv"), "w") as f:
        f.write("\n".join(lines[:3]) + "\n")
    stream_lead_counts(spark, src, mart, ckpt, available_now=True).awaitTermination(120)
    with open(os.path.join(src, "part2.csv"), "w") as f:
        f.write("\n".join([lines[0]] + lines[3:]) + "\n")
    stream_lead_counts(spark, src, mart, ckpt, available_now=True).awaitTermination(120)
    by_origin = {r.origin: r["count"] for r in read_published(spark, mart, "leads_by_origin").collect()}
    assert by_origin == {"paid_search": 3, "organic_search": 1}   # as the batch mart: only a NULL origin is dropped
    months = read_published(spark, mart, "leads_by_month_origin").count()
    assert months == 3


def test_streaming_review_sentiments(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "reviews.csv"), "w") as f:
        f.write(CSV["order_reviews"])
    lexicon = spark.createDataFrame(list(LEX.items()), "word string, weight double")
    stream_review_sentiments(spark, src, sink, ckpt, lexicon, available_now=True).awaitTermination(120)
    got = {r.review_id: r.sentiment for r in spark.read.parquet(sink).collect()}
    batch = {r.review_id: r.sentiment for r in sentiments(read_table(spark, src, "reviews", RAW_SCHEMAS["order_reviews"],
                                                                     multi_line=True), lexicon).collect()}
    assert got == batch and len(got) == 7 and got["r3"] == "negative" and got["r6"] == "positive"
