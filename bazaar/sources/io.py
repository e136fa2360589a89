"""Sources and sinks.

Files are addressed by URI (``file://``, ``s3a://``, ``gs://`` ...): Spark's
Hadoop file systems handle the object store, so there is no storage client.

``publish`` writes each version of a mart to a folder of its own and only then
adds a line to the mart's manifest, which ``read_published`` follows: readers
see the last whole version, whatever happens to a job that writes the next.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import delete
from bazaar.sources.schemas import MULTI_LINE, RAW_SCHEMAS

# text form of timestamps in CSV marts, as the store's own exports write them
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
MANIFEST = "version long, path string, fmt string, columns string"


def _path(base: str, name: str, ext: str) -> str:
    base = base.rstrip("/")
    return f"{base}/{name}" if name.endswith(ext) or "." in name.rsplit("/", 1)[-1] else f"{base}/{name}{ext}"


def csv_reader(spark: SparkSession, multi_line: bool = False):
    """Header row, doubled quotes inside quoted fields (T21), a byte-order mark
    is stripped (T22). A value that doesn't fit its type fails the query.
    Only ``multi_line`` files may hold line breaks in quoted fields; such a
    file is read by one task, all others are split."""
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("quote", '"').option("mode", "FAILFAST"))


def by_name(names: list[str], declared: T.StructType | None) -> T.StructType:
    """The schema of a file with these header names, in the file's order:
    declared columns take their declared type, others are text."""
    types = {f.name: f.dataType for f in declared.fields} if declared else {}
    return T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None,
               fmt: str = "csv", columns: list[str] | None = None, multi_line: bool | None = None) -> DataFrame:
    """Read one raw table.

    CSV columns are found by their header names, in any order; columns that
    the schema doesn't declare pass through as text (the marts that join whole
    files keep them). A declared column that the file lacks raises, as does a
    file of the table whose header differs from the first one's. ``columns``
    prunes the projection (S3): the scan then reads only those.
    """
    schema = schema or RAW_SCHEMAS.get(name)
    if fmt == "csv":
        path = _path(base, name, ".csv")
        reader = csv_reader(spark, name in MULTI_LINE if multi_line is None else multi_line)
        names = reader.csv(path).columns  # reads the header line
        needed = columns if columns is not None else [f.name for f in schema.fields] if schema else []
        if lacking := [c for c in needed if c not in names]:
            raise ValueError(f"{path} has no column {', '.join(lacking)}")
        df = reader.schema(by_name(names, schema)).option("enforceSchema", False).csv(path)
    elif fmt == "parquet":
        df = spark.read.parquet(_path(base, name, ".parquet"))
    else:
        df = spark.read.format(fmt).load(_path(base, name, ""))
    return df.select(*columns) if columns else df


def write_mart(df: DataFrame, base: str, name: str, fmt: str = "parquet",
               rename: Mapping[str, str] | None = None, partition_by: list[str] | None = None) -> str:
    """Overwrite one mart as a directory of part files.

    ``rename`` maps the snake-case names to export headers (e.g.
    ``at_time`` -> ``at time``) at the sink only. Returns the path written.
    """
    out = df.withColumnsRenamed(dict(rename)) if rename else df
    path = f"{base.rstrip('/')}/{name}"
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').option("timestampFormat", CSV_TIMESTAMP).option(
            "timestampNTZFormat", CSV_TIMESTAMP).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def publish(df: DataFrame, base: str, name: str, fmt: str = "parquet", rename: Mapping[str, str] | None = None,
            partition_by: list[str] | None = None) -> str:
    """Write the next version of a mart, then name it in the manifest.

    The manifest is a folder of one-line files; adding one is the only step
    that readers see, and a job that fails before it leaves the version before
    in place. One writer at a time for each mart. Returns the version's path.
    """
    spark, home = df.sparkSession, f"{base.rstrip('/')}/{name}"
    version = max((v["version"] for v in versions(spark, base, name)), default=0) + 1
    path = write_mart(df, f"{home}/data", f"{version:08d}-{uuid.uuid4().hex}", fmt, rename, partition_by)
    schema = (df.withColumnsRenamed(dict(rename)) if rename else df).schema
    line = spark.createDataFrame([(version, path, fmt, schema.json())], MANIFEST)
    line.coalesce(1).write.mode("append").json(f"{home}/manifest")
    return path


def versions(spark: SparkSession, base: str, name: str) -> list:
    """The published versions of a mart, the last one first: one small row each."""
    try:
        lines = spark.read.schema(MANIFEST).json(f"{base.rstrip('/')}/{name}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return lines.orderBy(F.desc("version")).collect()


def read_published(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """The last published version of a mart, or the one asked for."""
    found = [v for v in versions(spark, base, name) if version in (None, v["version"])]
    if not found:
        raise ValueError(f"{base}/{name} has no {'published version' if version is None else f'version {version}'}")
    schema = T.StructType.fromJson(json.loads(found[0]["columns"]))
    if found[0]["fmt"] == "csv":
        return (csv_reader(spark, True).option("timestampFormat", CSV_TIMESTAMP).option("timestampNTZFormat", CSV_TIMESTAMP)
                .schema(schema).csv(found[0]["path"]))
    return spark.read.format(found[0]["fmt"]).schema(schema).load(found[0]["path"])


def drop_versions(spark: SparkSession, base: str, name: str, keep: int = 2) -> list[str]:
    """Empty the data of all but the last ``keep`` versions and return their
    paths. Their manifest lines stay; call it when no reader uses them."""
    old = [v["path"] for v in versions(spark, base, name)[keep:]]
    for path in old:
        delete(spark, path)
    return old


def save_ratings(ratings: DataFrame, path: str, user_col: str = "customer_id",
                 product_col: str = "product_id", partitions: int | None = None) -> str:
    """Persist the long (user, product, rating) table as Parquet.

    Rows are hash-partitioned by user and sorted by (user, product) inside
    each file, so a single-user lookup reads few row groups (min/max
    statistics on the user column).
    """
    df = ratings.repartition(partitions, user_col) if partitions else ratings.repartition(user_col)
    df.sortWithinPartitions(user_col, product_col).write.mode("overwrite").parquet(path)
    return path


def save_ratings_table(ratings: DataFrame, table: str, buckets: int, user_col: str = "customer_id",
                       product_col: str = "product_id", path: str | None = None) -> DataFrame:
    """The ratings as a table of the session's catalog, bucketed by user and
    sorted by user and product. Joins and sums by user read it without a
    shuffle, see ``neighbours.recommend(bucketed=True)``. A user's rows are in
    one bucket, so choose it where no user holds a large share of them."""
    writer = (ratings.repartition(buckets, user_col).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, user_col).sortBy(user_col, product_col))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return ratings.sparkSession.table(table)


def load_ratings(spark: SparkSession, path: str, users: list | None = None,
                 user_col: str = "customer_id") -> DataFrame:
    """Read the ratings table, optionally for some users (pushed down)."""
    df = spark.read.parquet(path)
    return df.where(F.col(user_col).isin(users)) if users else df
