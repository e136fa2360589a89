"""Ratings as mergeable sums (M15, A9), kept current batch by batch.

A rating is a mean, and means can't be merged; sums and counts can. The state is
a table (part, user, product, total, n, batch) of one row for each pair of user
and product, partitioned by a hash of the user. A batch of new rows is summed
up, and only the partitions of its users are read and written again, by dynamic
partition overwrite. Each partition holds the number of the last batch that was
merged into it, so a batch that runs again, after a failure at any point, is
merged once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.joins import with_group_sum
from bazaar.session import stored

PARTS = 64  # partitions of users; fixed for a state


def read_sums(spark: SparkSession, path: str) -> DataFrame | None:
    """The state, None before the first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merge_ratings(rows: DataFrame, path: str, batch: int, user: str, product: str, score: str, parts: int = PARTS) -> None:
    """Add the scored rows of ``batch`` to the state at ``path``. Batches come
    in rising numbers, one at a time; one that runs again must hold the same
    rows. Rows without user, product or score are left out, as in the full
    build; an empty batch changes nothing."""
    spark = rows.sparkSession
    part = F.pmod(F.xxhash64(user), F.lit(parts)).cast("int")
    new = (rows.where(F.col(user).isNotNull() & F.col(product).isNotNull() & F.col(score).isNotNull())
           .groupBy(part.alias("part"), user, product)
           .agg(F.sum(F.col(score).cast("double")).alias("total"), F.count(F.lit(1)).alias("n")))
    new, old = stored(new, "rating-batch"), read_sums(spark, path)
    if old is not None:
        # ``parts`` rows
        last = old.groupBy("part").agg(F.max("batch").alias("last"))
        new = new.join(last, "part", "left").where(F.coalesce("last", F.lit(-1)) < batch).drop("last")
        touched = old.join(new.select("part").distinct(), "part", "left_semi").drop("batch")
        new = touched.unionByName(new).groupBy("part", user, product).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    # written on its own first: the state's files are replaced below while a lost task may need them again
    merged = stored(new.withColumn("batch", F.lit(batch).cast("long")), "rating-sums")
    (merged.repartition("part").sortWithinPartitions("part", user, product).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def ratings_of(sums: DataFrame, user: str, product: str, min_rows: int = 2, out: str = "rating") -> DataFrame:
    """R4 from the state: mean score of each pair, of users with at least
    ``min_rows`` rows."""
    return (with_group_sum(sums.select(user, product, "total", "n"), user, product, F.col("n"), "__user_rows")
            .where(F.col("__user_rows") >= min_rows).select(user, product, (F.col("total") / F.col("n")).alias(out)))
