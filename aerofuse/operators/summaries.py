"""Summaries and error metrics. Every one is a partial aggregate over a single scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.functions.airquality import ANNUAL_LIMIT, DAILY_LIMIT


def rmse(y: str, p: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2)))


def mae(y: str, p: str) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def r2(y: str, p: str) -> Column:
    """1 - SSE/SST. Constant truth gives 1 if met exactly, else 0; fewer than two rows give NULL."""
    pair = F.col(y).isNotNull() & F.col(p).isNotNull()
    truth = F.when(pair, F.col(y))
    residual = F.sum(F.pow(F.col(y) - F.col(p), 2))
    total = F.var_pop(truth) * F.count(truth)
    return (
        F.when(F.count(truth) < 2, F.lit(None).cast("double"))
        .when(F.min(truth) == F.max(truth), F.when(residual == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(residual, total))
    )


def regression_metrics(df: DataFrame, y: str = "y", p: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae and r2 together, for the whole table or per group."""
    return df.groupBy(*by).agg(rmse(y, p).alias("rmse"), mae(y, p).alias("mae"), r2(y, p).alias("r2"))


def fetch_summary(df: DataFrame, time: str = "time", station: str = "station_id") -> DataFrame:
    """Row count, period and number of stations; ``station_list`` gives their names."""
    return df.agg(
        F.count("*").alias("rows"),
        F.min(time).alias("start"),
        F.max(time).alias("end"),
        F.count_distinct(station).alias("stations"),
    )


def fetch_by_station(df: DataFrame, time: str = "time", station: str = "station_id") -> DataFrame:
    """Rows and period of every station by name, and of all of them in a row of scope ``all``, with their number
    and the columns of the table. Rows without a station count for a station of NULL name.

    The totals are rolled up from one row per station, so the table is aggregated once.
    """
    each = df.groupBy(station).agg(F.count("*").alias("rows"), F.min(time).alias("start"), F.max(time).alias("end"))
    both = each.rollup(station).agg(
        F.grouping(station).alias("_total"),
        F.sum("rows").alias("rows"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count(station).alias("stations"),
    )
    return both.select(
        F.when(F.col("_total") == 1, "all").otherwise("station").alias("scope"),
        station, "rows", "start", "end", "stations",
        F.when(F.col("_total") == 1, ", ".join(df.columns)).alias("columns"),
    )


def station_list(df: DataFrame, station: str = "station_id") -> DataFrame:
    return df.select(station).distinct()


def source_summary(df: DataFrame, measures: Sequence[str], station: str = "station_id", time: str = "time",
                   by: Sequence[str] = ()) -> DataFrame:
    """Distinct stations, period, and range and mean of every measure."""
    parts = [F.count_distinct(station).alias("stations"), F.min(time).alias("start"), F.max(time).alias("end")]
    for m in measures:
        parts += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), F.avg(m).alias(f"{m}_mean")]
    return df.groupBy(*by).agg(*parts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def distinct_cells(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct grid points."""
    if approximate:
        return df.agg(F.approx_count_distinct(F.struct("lat", "lon")).alias("cells"))
    return df.select("lat", "lon").distinct().agg(F.count("*").alias("cells"))


def log_summary(log: DataFrame, column: str = "pm25") -> DataFrame:
    return log.agg(F.count("*").alias("predictions"), F.avg(column).alias("mean"), F.max(column).alias("max"))


def score_summary(scored: DataFrame, column: str = "predicted_pm25") -> DataFrame:
    return scored.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"))


def limit_exceedance(df: DataFrame, column: str = "pm25", time: str = "time", station: str = "station_id") -> DataFrame:
    """Station and day, or station and year, whose mean is above the limit for that period."""
    # The daily sums are kept with their counts, so the years follow from the days, not from a second scan.
    daily = df.groupBy(station, F.date_trunc("day", time).cast("timestamp_ntz").alias("start")).agg(
        F.sum(column).alias("total"), F.count(column).alias("n")
    )
    yearly = daily.groupBy(station, F.date_trunc("year", "start").cast("timestamp_ntz").alias("start")).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )

    def mean_and_limit(totals: DataFrame, period: str, limit: float) -> DataFrame:
        mean = F.col("total") / F.col("n")
        return totals.select(
            station, "start", F.lit(period).alias("period"), mean.alias("mean"), F.lit(limit).alias("limit")
        )

    both = mean_and_limit(daily, "24h", DAILY_LIMIT).unionByName(mean_and_limit(yearly, "annual", ANNUAL_LIMIT))
    return both.where(F.col("mean") > F.col("limit"))
