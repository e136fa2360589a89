"""CSV files whose quoted fields hold line breaks, read by many tasks (S1), and
rows that don't fit their types set aside.

Spark's own multi-line reader gives a whole file to one task, as a line break
may be inside quotes that were opened any distance before. Whether it is, is
told by the number of quotes before it: odd inside, even outside (a doubled
quote inside quotes counts two and changes nothing). So the lines of each byte
range are read on their own with their number of quotes, the ranges' numbers
are summed up in the order of the file, and the sum before a range says whether
it begins inside quotes. Each line then either begins a record or continues the
last one, which may have begun ranges before; only records of several lines
are brought together.

``convert`` writes such a file once as Parquet. Rows that don't fit go to a
second table as they are, with the file they came from, and a bound on their
share decides whether the first is written at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import stored
from bazaar.sources.io import _path, by_name, csv_reader
from bazaar.sources.schemas import MULTI_LINE, RAW_SCHEMAS

BAD = "__bad_record"
RANGE = ("file", "start")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, line): lines in the order ``at`` within the byte range
    that begins at ``start``. A range is what one task reads of a file."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                      F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(file, first, record): the records of CSV files as they stand, without
    line ends after them and without blank lines; ``first`` marks the first of a
    file, its header. With ``multi_line`` a record may hold line breaks in
    quotes, and a quote that is never closed takes in the rest of its file;
    otherwise every line is a record. An empty file has none."""
    lines = _lines(spark, path)
    if not multi_line:
        # the header is the first line of a file's first range
        heads = lines.groupBy("file").agg(F.min(F.struct("start", "at")).alias("top"))
        own = (lines.join(F.broadcast(heads), "file").select("file", (F.struct("start", "at") == F.col("top")).alias("first"),
                                                F.col("line").alias("record")))
        return own.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.col("record") != "")
    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"')))).cast("long")
    lines = stored(lines.withColumn("quotes", quotes), "csv-lines")
    before = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range or file, some hundred bytes: broadcast, so that the lines stay where they are
    ranges = lines.groupBy(*RANGE).agg(F.sum("quotes").alias("quotes"))
    ranges = ranges.select(*RANGE, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("quotes_before"))
    begins = (F.col("quotes_before") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 0
    until = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = stored(lines.join(F.broadcast(ranges), list(RANGE)).withColumn("begins", begins)
                      .withColumn("nth", F.count_if("begins").over(until)).select(*RANGE, "at", "line", "nth"), "csv-numbered")
    # lines that continue a record of an earlier range belong to the last range before that began one
    counts = numbered.groupBy(*RANGE).agg(F.max("nth").alias("n"))
    last = F.last(F.when(F.col("n") > 0, F.struct(F.col("start").alias("from"), F.col("n").alias("of"))), ignorenulls=True)
    owners = counts.select(*RANGE, last.over(earlier).alias("owner"))
    owned = (numbered.join(F.broadcast(owners), list(RANGE))
             .withColumn("from", F.when(F.col("nth") > 0, F.col("start")).otherwise(F.col("owner.from")))
             .withColumn("of", F.when(F.col("nth") > 0, F.col("nth")).otherwise(F.col("owner.of"))))
    key = ["file", "from", "of"]
    size = owned.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"), F.min("at").alias("at")).where(F.col("lines") > 1)
    several = stored(size.select(*key), "csv-long-records")
    one = owned.join(several, key, "left_anti").select(*key, F.col("line").alias("record"))
    many = (owned.join(several, key, "left_semi").groupBy(*key)
            .agg(F.sort_array(F.collect_list(F.struct("start", "at", "line"))).alias("parts"))
            .select(*key, F.array_join(F.col("parts.line"), "\n").alias("record")))
    out = one.unionByName(many)
    heads = out.groupBy("file").agg(F.min(F.struct("from", "of")).alias("top"))
    out = out.join(F.broadcast(heads), "file").select("file", (F.struct("from", "of") == F.col("top")).alias("first"),
                                         F.regexp_replace("record", "\r$", "").alias("record"))
    return out.where(F.col("record") != "")


def parsed(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None,
           multi_line: bool | None = None) -> DataFrame:
    """The rows of a raw CSV table as ``read_table`` types them, with the
    columns ``__file`` and ``__bad_record``: the record as it stands where it
    doesn't fit (a value of another type, too many or too few fields), else
    null. Raises where a declared column is lacking or the files' headers
    differ."""
    schema = schema or RAW_SCHEMAS.get(name)
    path = _path(base, name, ".csv")
    names = csv_reader(spark, True).csv(path).columns
    if lacking := [f.name for f in schema.fields if f.name not in names] if schema else []:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    several = name in MULTI_LINE if multi_line is None else multi_line
    rows = records(spark, path, several)
    if several:  # put together with shuffles; single lines are read again instead
        rows = stored(rows, "csv-records")
    headers = rows.where("first").select(F.regexp_replace("record", "^﻿", "").alias("record")).distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"files of {path} have different headers: {[h['record'] for h in headers]}")
    typed = T.StructType([*by_name(names, schema).fields, T.StructField(BAD, T.StringType())])
    options = {"escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "multiLine": "true"}
    row = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed), options)
    return rows.where(~F.col("first")).select(F.col("file").alias("__file"), row.alias("row")).select("row.*", "__file")


def convert(spark: SparkSession, base: str, name: str, good: str, bad: str, most_bad: float = 0.001,
            schema: T.StructType | None = None, multi_line: bool | None = None) -> dict[str, int]:
    """Write a raw CSV table as Parquet to ``good``, and the records that don't
    fit, (file, record), to ``bad``; the numbers of rows of both.

    ``bad`` is written first. If its share is above ``most_bad``, ``good`` is
    left as it was and a ValueError tells the numbers.
    """
    rows = parsed(spark, base, name, schema, multi_line)  # parsed twice rather than written once more
    out = rows.where(F.col(BAD).isNotNull()).select(F.col("__file").alias("file"), F.col(BAD).alias("record"))
    out.write.mode("overwrite").parquet(bad)
    n, n_bad = rows.count(), spark.read.schema(out.schema).parquet(bad).count()
    if n_bad > most_bad * n:
        raise ValueError(f"{n_bad} of {n} records of {name} do not fit; see {bad}")
    rows.where(F.col(BAD).isNull()).drop(BAD, "__file").write.mode("overwrite").parquet(good)
    return {"rows": n - n_bad, "bad": n_bad}
