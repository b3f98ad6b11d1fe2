"""Long measurements to wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: factor used when a file holds no coarse particle readings at all.
PM10_PER_PM25 = 1.5


def pivot_measurements(long: DataFrame, keys: Sequence[str], order: str,
                       parameters: Sequence[str] = ("pm25", "pm10")) -> DataFrame:
    """One row per key with a column per parameter; among several values the last in ``order`` wins.

    Plain conditional aggregates, combined map-side, so copies of a key never gather in one task.
    """
    wanted = long.where(F.col("parameter").isin(list(parameters)))
    return wanted.groupBy(*keys).agg(
        *(
            F.max_by(F.when(F.col("parameter") == p, F.col("value")), F.when(F.col("parameter") == p, F.col(order)))
            .alias(p)
            for p in parameters
        )
    )


def _parameter(long: DataFrame, name: str) -> DataFrame:
    return long.where(F.col("parameter") == name).withColumnRenamed("value", name).drop("parameter")


def merge_pm10(long: DataFrame, on: Sequence[str] = ("time", "lat", "lon"), key: str | None = None) -> DataFrame:
    """Fine readings with the coarse reading of the same ``on``; several coarse readings repeat the row.

    ``key`` names the identifier of a long row; that of the coarse reading is kept as ``pm10_<key>``.
    If the input holds no coarse reading at all, it is estimated from the fine one.
    """
    kept = [F.col(key).alias(f"pm10_{key}")] if key else []
    fine, coarse = _parameter(long, "pm25"), _parameter(long, "pm10").select(*on, "pm10", *kept)
    return estimate_pm10(fine.join(coarse, list(on), "left"), long)


def latest_measurements(long: DataFrame, key: str, on: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """One row per ``on`` that has a fine reading: the last fine and the last known coarse one, by ``key``.

    The columns are those of ``merge_pm10(..., key=key)``, without its repetitions: where only the last
    reading counts, as in ``match_update``, the result is the same. One scan, combined map-side.
    """
    fine, coarse = F.col("parameter") == "pm25", (F.col("parameter") == "pm10") & F.col("value").isNotNull()
    last = long.where(F.col("parameter").isin("pm25", "pm10")).groupBy(*on).agg(
        F.max(F.when(fine, F.struct(key, "value"))).alias("fine"),
        F.max(F.when(coarse, F.struct(key, "value"))).alias("coarse"),
    )
    wide = last.where(F.col("fine").isNotNull()).select(
        *on,
        F.col(f"fine.{key}").alias(key),
        F.col("fine.value").alias("pm25"),
        F.col(f"coarse.{key}").alias(f"pm10_{key}"),
        F.col("coarse.value").alias("pm10"),
    )
    return estimate_pm10(wide, long)


def estimate_pm10(wide: DataFrame, long: DataFrame) -> DataFrame:
    """Estimate coarse readings only where the long input has none for any row."""
    has_coarse = long.where(F.col("parameter") == "pm10").select(F.lit(1)).exists()
    return wide.withColumn("pm10", F.when(has_coarse, F.col("pm10")).otherwise(F.col("pm25") * PM10_PER_PM25))
