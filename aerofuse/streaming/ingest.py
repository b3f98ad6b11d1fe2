"""Measurements and predictions that arrive over time, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerofuse.params import TrainingParams
from aerofuse.plans.forest_model import ForestModel
from aerofuse.plans.training import score
from aerofuse.streaming.committed import CommittedTable, stream_id

KEYS = ("station_id", "parameter", "time")
# State of the running queries is kept on executor disk, with change logs in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType | str, file_format: str = "parquet",
                  pattern: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files of a landing folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(file_format).load(folder)


def first_of_batch(df: DataFrame, order: str, keys: Sequence[str] = KEYS, known: DataFrame | None = None) -> DataFrame:
    """Batch twin: the first row in ``order`` per key, without the keys already ``known``. Null keys are keys, too."""
    others = [c for c in df.columns if c not in (*keys, order)]
    packed = F.min_by(F.struct(*others), order).alias("first") if others else F.lit(None).alias("first")
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order), packed)
    rows = firsts.select(*keys, order, *(F.col(f"first.{c}").alias(c) for c in others)).select(*df.columns)
    if known is None:
        return rows
    seen = known.select(*(F.col(k).alias(f"known {n}") for n, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"known {n}")) for n, k in enumerate(keys)]
    return rows.join(seen, same, "left_anti")


def add_new(stream: DataFrame, path: str, checkpoint: str, order: str, keys: Sequence[str] = KEYS,
            time: str = "time") -> StreamingQuery:
    """Append each measurement once to the committed table under ``path``, however late or often it arrives.

    A batch keeps its first row per key in ``order`` and leaves out keys that are committed, by this checkpoint or
    any other, looked up in the days that the batch touches (rows without time: in those without day). Read the
    table with ``measurements``.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table, own = CommittedTable(spark, path, ["date"]), stream_id(spark)
        if table.holds(own, number):
            return
        rows = batch.withColumn("date", F.to_date(time)).persist()
        try:
            days = rows.agg(F.min("date").alias("low"), F.max("date").alias("high"), F.count_if(F.isnull("date")).alias("none")).first()
            known = table.read(rows.schema).where(
                F.col("date").between(F.lit(days["low"]), F.lit(days["high"])) | (F.col("date").isNull() & F.lit(days["none"] > 0)))
            table.add(first_of_batch(rows, order, keys, known), own, number)
        finally:
            rows.unpersist()

    return _by_batch(stream, add, checkpoint)


def measurements(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that ``add_new`` writes; ``schema`` is that of its stream."""
    return CommittedTable(spark, path).read(T.StructType([*schema.fields, T.StructField("date", T.DateType())])).select(*schema.names)


def add_daily_sums(stream: DataFrame, path: str, checkpoint: str, value: str, station: str = "station_id",
                   time: str = "time") -> StreamingQuery:
    """Append each batch's sums and counts per station and day; ``daily_means`` adds them up.

    Sums cannot tell a row that is read again, so the table belongs to the checkpoint that began it: another one is refused.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table, own = CommittedTable(spark, path), stream_id(spark)
        others = table.streams() - {own}
        if others:
            raise ValueError(f"{path} is added to by another checkpoint ({', '.join(sorted(others))})")
        table.add(_daily(batch, value, station, time), own, number)

    return _by_batch(stream, add, checkpoint)


def _daily(rows: DataFrame, value: str, station: str, time: str) -> DataFrame:
    day = F.date_trunc("day", F.col(time).cast("timestamp_ltz")).cast("timestamp_ntz").alias("start")
    return rows.groupBy(station, day).agg(F.sum(F.col(value).cast("double")).alias("total"), F.count(value).alias("n"))


def daily_sums(spark: SparkSession, path: str, station: T.StructField | None = None) -> DataFrame:
    """The table that ``add_daily_sums`` writes."""
    field = station or T.StructField("station_id", T.StringType())
    return CommittedTable(spark, path).read(T.StructType([field]).add("start", "timestamp_ntz").add("total", "double").add("n", "long"))


def daily_means(sums: DataFrame, station: str = "station_id") -> DataFrame:
    """24-hour mean per station of all days, late rows included, from the table that ``add_daily_sums`` writes."""
    total = sums.groupBy(station, "start").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return total.select(station, "start", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"), "n")


def _by_batch(stream: DataFrame, add, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_stream(stream: DataFrame, model: ForestModel, params: TrainingParams = TrainingParams(),
                 time: str = "time") -> DataFrame:
    """Predictions with the day they are filed under."""
    scored = score(model, stream, params, "predicted_pm25")
    return scored.withColumn("date", F.to_date(time))


def write_available(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process all that has arrived, then stop. Restarting from the checkpoint takes only new files."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()
