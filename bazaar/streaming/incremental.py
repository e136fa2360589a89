"""Incremental upkeep of marts as raw files keep arriving.

The store application rebuilds its marts from whole files on every call. With
Structured Streaming the same batch operators run over a file source. The
lead-count marts (M11, M12) keep one count per (year, month, origin) in the
state store, bounded by the calendar and the origins, not by the data, and
publish both marts anew after each micro-batch. Review sentiment (M17) is computed
per micro-batch and appended. Progress and state live in ``checkpoint``, a
folder on shared storage, so a restarted query resumes where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaar.functions.columns import period_first, period_last, ts_or_null
from bazaar.plans.marts import sentiments
from bazaar.sources.io import drop_versions
from bazaar.sources.io import publish as publish_mart
from bazaar.sources.schemas import MULTI_LINE, RAW_SCHEMAS


def _csv_stream(spark: SparkSession, source_dir: str, name: str, max_files: int) -> DataFrame:
    """Files of exactly the declared columns, in their order; any other header
    fails the query."""
    return (spark.readStream.schema(RAW_SCHEMAS[name]).option("header", True).option("enforceSchema", False)
            .option("multiLine", name in MULTI_LINE).option("escape", '"').option("mode", "FAILFAST")
            .option("maxFilesPerTrigger", max_files).csv(source_dir))


def stream_lead_counts(spark: SparkSession, source_dir: str, mart_dir: str, checkpoint: str,
                       available_now: bool = False, max_files: int = 100) -> StreamingQuery:
    """M11 and M12 kept current from lead files landing in ``source_dir``.

    A lead without a readable date counts for M12 but has no month in M11, as
    in the batch marts. Each micro-batch gives the counts of all keys
    (complete mode), which are held for the batch and published as versions of
    both marts (``sources.io.read_published``); a batch that runs again
    publishes the same counts again. Versions before the last two are removed.
    """
    leads = _csv_stream(spark, source_dir, "leads", max_files)
    parsed = leads.select(ts_or_null("first_contact_date").alias("t"), "origin")
    counts = (parsed.where(F.col("origin").isNotNull())
              .groupBy(F.year("t").alias("year"), F.month("t").alias("month"), "origin")
              .agg(F.count("origin").alias("count")))

    def publish(batch: DataFrame, epoch: int) -> None:
        counted = batch.persist()
        by_month = counted.where(F.col("year").isNotNull()).select(
            F.col("year").cast("string").alias("year"), F.col("month").cast("string").alias("month"),
            "origin", "count", period_first("year", "month").alias("first"),
            period_last("year", "month").alias("last"))
        publish_mart(by_month, mart_dir, "leads_by_month_origin")
        publish_mart(counted.groupBy("origin").agg(F.sum("count").alias("count")), mart_dir, "leads_by_origin")
        for name in ("leads_by_month_origin", "leads_by_origin"):
            drop_versions(spark, mart_dir, name)
        counted.unpersist()

    return _started(counts.writeStream.outputMode("complete").foreachBatch(publish), checkpoint, available_now)


def stream_review_sentiments(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                             lexicon: DataFrame, available_now: bool = False,
                             max_files: int = 100) -> StreamingQuery:
    """M17 for each review file landing in ``source_dir``: a folder of Parquet
    files per micro-batch, overwritten if the batch runs again."""
    reviews = _csv_stream(spark, source_dir, "order_reviews", max_files)

    def publish(batch: DataFrame, epoch: int) -> None:
        sentiments(batch, lexicon).write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={epoch}")

    return _started(reviews.writeStream.foreachBatch(publish), checkpoint, available_now)


def _started(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
