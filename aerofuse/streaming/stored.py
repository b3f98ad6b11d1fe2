"""Summaries of a growing table, kept as parts that are added up on read.

A batch leaves one row per group and day: its number of rows, its first and last time, count, sum, least and greatest of every
measure, and a sketch of the distinct values of every counted key. Parts of a group merge into what one scan of all rows would give,
so a summary after an append reads the new rows and the parts, not the rows that came before. Numbers of distinct values are
estimates of a HyperLogLog sketch with a relative standard error of about 1.04 / sqrt(2 ** SKETCH_BITS), 1.6 %; they are exact
where the key is one of the groups and the merged rows are counted.

Parts lie in a committed table: a batch that is added again changes nothing. Rows without time have parts without day; null
measures and keys are not counted; NaN counts as null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerofuse.streaming.committed import CommittedTable, stream_id

SKETCH_BITS = 12


@dataclass(frozen=True)
class StoredSummary:
    """What is kept: ``by`` are the groups, ``measures`` the numbers, ``distinct`` names the columns of each counted key."""

    by: Sequence[str] = ()
    measures: Sequence[str] = ()
    distinct: dict[str, Sequence[str]] = field(default_factory=dict)
    time: str = "time"

    def parts(self, rows: DataFrame) -> DataFrame:
        """One row per group and day. A hot group or day is combined before it is shuffled."""
        day = F.to_date(F.col(self.time)).alias("day")
        kept = [F.count(F.lit(1)).alias("rows"), F.min(self.time).alias("start"), F.max(self.time).alias("end")]
        for m in self.measures:
            value = F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double"))
            kept += [F.count(value).alias(f"{m}_n"), F.sum(value).alias(f"{m}_sum"), F.min(value).alias(f"{m}_min"), F.max(value).alias(f"{m}_max")]
        for name, columns in self.distinct.items():
            kept.append(F.hll_sketch_agg(_key(columns), F.lit(SKETCH_BITS)).alias(f"{name}_sketch"))
        return rows.groupBy(*self.by, day).agg(*kept)

    def merged(self, parts: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """One row per group of ``by`` (all groups if None; ``day`` is one, too): rows, start, end, n, mean, min and max of the
        measures, and estimates of the distinct keys."""
        out = [F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.min("start").alias("start"), F.max("end").alias("end")]
        for m in self.measures:
            n = F.sum(f"{m}_n")
            out += [F.coalesce(n, F.lit(0)).cast("long").alias(f"{m}_n"), F.try_divide(F.sum(f"{m}_sum"), n).alias(f"{m}_mean"),
                    F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
        for name in self.distinct:
            estimate = F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch"))
            out.append(F.coalesce(estimate, F.lit(0)).cast("long").alias(name))
        return parts.groupBy(*(self.by if by is None else by)).agg(*out)

    def add(self, rows: DataFrame, path: str, stream: str, batch: int) -> bool:
        """Add the parts of a batch, unless it has been committed; tells whether it was added."""
        return CommittedTable(rows.sparkSession, path).add(self.parts(rows), stream, batch)

    def add_stream(self, rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
        """Add what has arrived. Parts cannot tell a row that is read again, so the table belongs to the checkpoint that
        began it: another one is refused."""

        def add(batch: DataFrame, number: int) -> None:
            own = stream_id(batch.sparkSession)
            others = CommittedTable(batch.sparkSession, path).streams() - {own}
            if others:
                raise ValueError(f"{path} is added to by another checkpoint ({', '.join(sorted(others))})")
            self.add(batch, path, own, number)

        return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        """The parts under ``path``; ``schema`` is that of the rows."""
        return CommittedTable(spark, path).read(self.parts(spark.createDataFrame([], schema)).schema)


def _key(columns: Sequence[str]) -> Column:
    """A number for the values of the columns; null if any of them is."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.xxhash64(*columns))
