"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Row ceiling under which a frame whose size has been counted may be broadcast.
# Every frame it is applied to is narrow (at most a handful of fixed-width columns),
# so this stays within a few tens of megabytes per executor.
BROADCAST_ROWS = 500_000


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on: UTC and zone-less timestamps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions for an input of this size; returns it.

    AQE merges partitions that turn out small but does not cut the ranges of a range shuffle, so the
    number has to be large enough beforehand.
    """
    partitions = max(-(-input_bytes // partition_bytes), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it back.

    Used where a value must not change if a task is run again (range shard numbers)
    or where a small derived table is used several times.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``materialize``, with the number of rows observed while they were written."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return written, seen.get["rows"]


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of a few rows held in the plan itself, so that it starts no Python worker."""
    names = [field.split()[0] for field in schema.split(", ")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when the counted size permits it; else leave the choice to AQE."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def micros(column: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (session zone UTC)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp_ltz"))


def local_session(cores: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the bench on one machine. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("aerofuse")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
