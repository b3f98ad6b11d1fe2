"""Days that are closed: the mean of each station and day, emitted once, when no more rows are waited for.

State is kept per station on executor disk: a sum and a count per open day, and a timer at the day's end. A row is late
if its day had been closed before its batch; late rows go to a table of their own, so that

    closed days + late rows + open days = all rows.

The watermark trails the newest time seen by ``delay``. Rows without time have no day and go to the late rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from aerofuse.streaming.committed import CommittedTable, stream_id
from aerofuse.streaming.ingest import use_disk_state

DAY_MS = 86_400_000
_OUT = "station string, start timestamp_ntz, total double, n long, time timestamp_ntz, value double, late boolean"
CLOSED = "station string, start timestamp_ntz, mean double, n long"
LATE = "station string, time timestamp_ntz, value double"


class DayCloser(StatefulProcessor):
    """Sums of open days by the millisecond they end at; rows of days that are closed pass through as late."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "end long", "total double, n long, rows long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            end = (batch["ms"] // DAY_MS + 1) * DAY_MS
            late = batch["ms"].isna() | (end <= watermark)
            if late.any():
                some = batch[late]
                yield pd.DataFrame({
                    "station": key[0], "start": pd.NaT, "total": None, "n": 0, "time": pd.to_datetime(some["ms"], unit="ms"),
                    "value": some["value"], "late": True})
            for day, values in batch[~late].groupby(end[~late].astype("int64"))["value"]:
                before = self.days.getValue((int(day),)) if self.days.containsKey((int(day),)) else None
                total, n, k = before or (0.0, 0, 0)
                if before is None:
                    self.handle.registerTimer(int(day))
                self.days.updateValue((int(day),), (total + float(values.sum()), n + int(values.count()), k + len(values)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        total, n, _ = self.days.getValue((end,))
        self.days.removeKey((end,))
        yield pd.DataFrame({
            "station": [key[0]], "start": pd.to_datetime([end - DAY_MS], unit="ms"), "total": [total], "n": [n],
            "time": pd.to_datetime([None]), "value": [None], "late": [False]})

    def close(self) -> None:
        pass


def close_days(stream: DataFrame, path: str, checkpoint: str, value: str, delay: str = "1 day", station: str = "station_id",
               time: str = "time") -> StreamingQuery:
    """Add closed days to the committed table ``path/closed`` and late rows to ``path/late``, each exactly once.

    ``closed_days`` and ``late_rows`` read them. Days that are still open stay in the state of the checkpoint.
    """
    use_disk_state(stream.sparkSession)
    marked = stream.withColumn("_at", F.col(time).cast("timestamp_ltz")).withWatermark("_at", delay)
    # The operator would drop late rows by the column that carries the watermark, so it gets the time as a number.
    rows = marked.select(
        F.col(station).cast("string").alias("station"), F.unix_millis("_at").alias("ms"), F.col(value).cast("double").alias("value"))
    out = rows.groupBy("station").transformWithStateInPandas(
        DayCloser(), outputStructType=T.StructType.fromDDL(_OUT), outputMode="append", timeMode="eventTime")

    def add(batch: DataFrame, number: int) -> None:
        spark, own = batch.sparkSession, stream_id(batch.sparkSession)
        rows = batch.persist()
        try:
            closed = rows.where(~F.col("late")).select("station", "start", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"), "n")
            CommittedTable(spark, f"{path}/closed").add(closed, own, number)
            CommittedTable(spark, f"{path}/late").add(rows.where("late").select("station", "time", "value"), own, number)
        finally:
            rows.unpersist()

    return out.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """station, start, mean, n of every closed day."""
    return CommittedTable(spark, f"{path}/closed").read(T.StructType.fromDDL(CLOSED))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """station, time, value of every row that came after its day was closed, or had no time."""
    return CommittedTable(spark, f"{path}/late").read(T.StructType.fromDDL(LATE))
