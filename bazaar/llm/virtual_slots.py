"""Sharding by fixed virtual slots.

Every record is hashed into one of some thousands of slots, for good. Bytes and
rows are summed per slot, and a map from slots to shards, made from those sums,
spreads the bytes evenly: the largest slot left goes to the least loaded shard.
Maps are kept under rising versions. Rebalancing edits the map: only slots of
shards above the new mean move, and only to shards below it, so that a further
shard takes rows into itself and no others move.

Only the per-slot sums, one row a slot, come together in one row, in which a
fold over an array deals them out; records meet by slot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from bazaar.llm.common import pick, shared_dir, stored
from bazaar.operators.joins import attach

SLOTS = 4_096
SLACK = 0.01    # of the mean, that a shard may hold above it before its slots move
HOT_ROWS = 32   # rows of one id, beyond which they are dealt to slots one by one


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, virtual_slot, row_) of every record.

    size: the text's UTF-8 bytes (a null text has none) and one. The slot is a
    hash of the id, of the text for a null id, so it holds whatever else the
    table contains. Rows of an id that more than ``HOT_ROWS`` rows share would
    make one slot too large to place; each is hashed with its place in the
    table instead. The table is written once, so places are the same for every
    later job.
    """
    own = pick(docs, **{id_col: "long", text_col: "string"})
    text = F.coalesce(text_col, F.lit(""))
    own = stored(own.select(
        id_col, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col(id_col).isNull(), F.xxhash64(F.lit("text"), text)).otherwise(F.xxhash64(id_col)).alias("key_"),
        F.monotonically_increasing_id().alias("row_")), "records")
    hot = stored(own.groupBy("key_").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS)
                 .select("key_", F.lit(1).alias("hot_")), "hot-ids", rows=1)
    marked = attach(own, "key_", "row_", hot, {"hot_": 0})
    slot = F.when(F.col("hot_") == 1, F.xxhash64("key_", "row_")).otherwise(F.col("key_"))
    return marked.withColumn("virtual_slot", F.pmod(slot, F.lit(slots)).cast("int")).drop("key_", "hot_")


def slot_sums(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, n_rows) of all slots, empty ones too: ``slots`` rows."""
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    return stored(every.join(sums, "virtual_slot", "left").na.fill(0, ["bytes", "n_rows"]), "slot-sums", rows=slots)


def _dealt(loose: DataFrame, loads: Column) -> DataFrame:
    """(virtual_slot, shard): loose slots (virtual_slot, bytes), the largest
    first, each to the shard of the least load so far. ``loads``: an array of
    (shard, bytes) structs by which the shards start; of equal loads the first."""
    row = loose.agg(F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot"))).alias("s"))
    row = row.withColumn("loads", loads).select("s", F.col("loads.bytes").alias("load"), F.col("loads.shard").alias("shards"))

    def step(state: Column, slot: Column) -> Column:
        least = F.array_position(state["load"], F.array_min(state["load"])).cast("int")
        load = F.transform(state["load"], lambda x, i: F.when(i == least - 1, x - slot["less"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(least)).alias("to"))

    start = F.struct(F.col("load"), F.array().cast("array<int>").alias("to"))
    to = F.aggregate("s", start, step, lambda state: state["to"])
    return (row.select("s", "shards", to.alias("to"))
            .select("shards", F.explode(F.arrays_zip("s", "to")).alias("x"))
            .select(F.col("x.s.virtual_slot").alias("virtual_slot"), F.element_at("shards", F.col("x.to")).alias("shard")))


def first_map(sums: DataFrame, shards: int) -> DataFrame:
    """(virtual_slot, shard, bytes, n_rows) over shards 0 to ``shards`` - 1."""
    loads = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(0).cast("long").alias("bytes")) for i in range(shards)])
    return sums.join(_dealt(sums, loads), "virtual_slot")


def edited_map(old: DataFrame, sums: DataFrame, shards: int) -> DataFrame:
    """The map ``old`` (virtual_slot, shard) edited for these sums and this
    number of shards.

    A shard above the mean, by more than ``SLACK``, keeps its larger slots until
    they come nearest to the mean; its others are loose, as are all of a shard
    that is no longer there. Loose slots go to the shards below the mean that
    gave none. All other slots stay.
    """
    now = sums.join(old.select("virtual_slot", "shard"), "virtual_slot")
    mean = sums.agg((F.sum("bytes") / shards).alias("mean"))
    own = Window.partitionBy("shard")
    larger = own.orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    now = now.withColumns({"mean": mean.scalar(), "load": F.sum("bytes").over(own),
                           "larger": F.coalesce(F.sum("bytes").over(larger), F.lit(0))})
    fits = (F.col("load") <= F.col("mean") * (1 + SLACK)) | (F.col("larger") + F.col("bytes") / 2 < F.col("mean"))
    now = stored(now.withColumn("stays", (F.col("shard") < shards) & fits).drop("mean", "load", "larger"), "slot-moves", rows=SLOTS)
    kept = now.where("stays")
    moved = now.where(~F.col("stays"))
    ids = kept.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    room = (ids.join(moved.select("shard"), "shard", "left_anti").join(kept.groupBy("shard").agg(F.sum("bytes").alias("bytes")), "shard", "left")
            .na.fill(0, ["bytes"]).where(F.col("bytes") <= mean.scalar())
            .agg(F.sort_array(F.collect_list(F.struct("shard", "bytes")))))
    moves = moved.drop("shard").join(_dealt(moved.select("virtual_slot", "bytes"), room.scalar()), "virtual_slot")
    return kept.select("virtual_slot", "shard", "bytes", "n_rows").unionByName(
        moves.select("virtual_slot", "shard", "bytes", "n_rows"))


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """A version of the map (with its ``version``), the latest by default;
    None where the folder holds none."""
    try:
        maps = spark.read.parquet(folder)
    except AnalysisException:
        return None
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version)


def write_map(slot_map: DataFrame, folder: str) -> int:
    """Store the map as the next version and return its number; one writer at a time. Versions that are there
    stay as they are; a version counts once all its rows are written."""
    spark = slot_map.sparkSession
    last = read_map(spark, folder)
    version = 1 if last is None else last.select("version").first()[0] + 1
    slot_map.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")
    return version


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The records with their ``shard`` and ``place`` in it, gapless from 0: by
    slot, in a slot by id. The map must hold the rows of these records' slots."""
    first = F.sum("n_rows").over(Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("n_rows")
    starts = slot_map.select("virtual_slot", "shard", first.alias("first_"))
    own = Window.partitionBy("virtual_slot").orderBy(records.columns[0], "text_crc32", "size", "row_")
    return (records.withColumn("nth_", F.row_number().over(own) - 1).join(starts, "virtual_slot")
            .withColumn("place", F.col("first_") + F.col("nth_")).drop("first_", "nth_", "row_"))


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, virtual_slot, shard, place, version) of every
    document, in shards of near equal bytes.

    ``folder`` holds the versions of the map: its latest is edited if it has
    another number of shards, or shards whose bytes are over the mean by more
    than a slot; by default a new one is begun in the shared folder. Null ids
    and texts, repeated rows and equal ids are records like any other; a very
    long text weighs its bytes, and one that alone is above the mean stays one
    record. An empty table gives an empty one, and a map of empty slots. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    records = slotted(docs, slots, id_col, text_col)
    sums = slot_sums(records, slots)
    folder = folder or f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    old = read_map(spark, folder)
    version = write_map(first_map(sums, shards) if old is None else edited_map(old, sums, shards), folder)
    slot_map = read_map(spark, folder, version)
    return placed(records, slot_map.drop("version")).withColumn("version", F.lit(version))
