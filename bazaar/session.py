"""Session settings and lineage helpers.

The library never owns cluster settings: ``tune`` only fills SQL runtime
options that the session has not set, and ``shared_dir`` reads the folder the
cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL options the plans rely on. Only applied where unset.
RUNTIME_DEFAULTS = {
    # AQE re-plans joins on measured sizes (broadcast below the threshold,
    # sort-merge above it), coalesces small shuffle partitions and splits
    # skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalescing sizes a stage by its input; the neighbour self join expands
    # its input ~15x, so small coalesced partitions keep every core busy
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    # sizes of stored tables are those of compressed files, a tenth of what the
    # driver would hold of them; at run time Spark knows the rows' own size
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Fill runtime options that are not set yet. The session's time zone is
    the caller's: the store's timestamps have none."""
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "bazaar",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the local benchmark (single JVM, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("BAZAAR_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of
    the session. Only a local session that names none gets a temporary one; on
    a cluster a machine-local folder would not survive a lost executor."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not conf:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
            conf = tempfile.mkdtemp(prefix="bazaar-shared-")
        sc.setCheckpointDir(conf)
    return sc.getCheckpointDir().rstrip("/")


ROWS_PER_FILE = 250_000
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}  # Hadoop's names of schemes where Arrow has others
_written: list[list[str]] = []  # paths of the tables stored within each open ``tables_dropped``


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark reaches."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextlib.contextmanager
def tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are ``stored`` within the block when it ends. For
    jobs that write their results inside it: a frame that is only read later
    would lose its input."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            delete(spark, path)


def arrow_path(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path by which tasks in Python read a file that Spark
    names by its URI."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + unquote(rest).lstrip("/")
    return fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


def stored(df: DataFrame, name: str, rows: int | None = None, codec: str = "zstd", by: Sequence[str] = ()) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Used where one derived table feeds several jobs (ratings, neighbours):
    later jobs and a lost executor read its files instead of computing it
    again, joins see its real size, and its rows arrive as plain scans, so
    that a skewed key of a join with it can be split. ``rows``: about how many
    rows of a few numbers it can have; a small table is then not written as a
    file per shuffle partition. ``by``: columns by whose values the files are
    dealt to folders. The table stays until its folder is removed,
    or until the end of a ``tables_dropped`` block around it.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    df.write.option("compression", codec).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
