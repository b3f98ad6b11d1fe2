"""Streams over the events file and their batch twins."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aerofuse.catalog.binding import Part, rounded
from aerofuse.catalog.fixtures import BASE_TABLES, spark_view, with_views
from aerofuse.catalog.models import FEATURES, PARAMS, fitted, in_range
from aerofuse.catalog.scans import landing_path
from aerofuse.session import prepare
from aerofuse.streaming import closing, ingest
from aerofuse.streaming.stored import StoredSummary

part = Part()


def _event_stream(spark: SparkSession, sf_dir: str):
    return ingest.read_arrivals(spark, sf_dir, BASE_TABLES["events"], pattern="events.parquet")


def _run(stream, label: str, partition_by=()):
    """Process what is there and read the result."""
    path = landing_path(stream, label)
    ingest.write_available(stream, f"{path}/rows", f"{path}/state", partition_by).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


@part.query("obs_long", sql="""
    SELECT station_id, parameter, time, min(event_id) AS event_id, arg_min(value, event_id) AS value
    FROM obs_long GROUP BY station_id, parameter, time""")
def ingest_dedup(obs_long):
    rows = obs_long.select("station_id", "parameter", "time", "event_id", "value")
    return ingest.first_of_batch(rows, "event_id")


def ingest_stream(spark: SparkSession, sf_dir: str):
    prepare(spark)
    arrivals = spark_view(spark, sf_dir, "obs_long", events=_event_stream(spark, sf_dir)).select(
        "station_id", "parameter", "time", "event_id", "value")
    path = landing_path(arrivals, "ingest")
    ingest.add_new(arrivals, f"{path}/rows", f"{path}/state", "event_id").awaitTermination()
    return ingest.measurements(spark, f"{path}/rows", arrivals.schema)


def stream_24h(spark: SparkSession, sf_dir: str):
    prepare(spark)
    arrivals = spark_view(spark, sf_dir, "obs", events=_event_stream(spark, sf_dir))
    path = landing_path(arrivals, "daily")
    ingest.add_daily_sums(arrivals, f"{path}/rows", f"{path}/state", "pm25").awaitTermination()
    return rounded(ingest.daily_means(ingest.daily_sums(spark, f"{path}/rows")))


def closed_days(spark: SparkSession, sf_dir: str):
    """Nine tenths of the observations arrive first, the others after days have been closed."""
    prepare(spark)
    obs = spark_view(spark, sf_dir, "obs").select("event_id", "station_id", "time", "pm25")
    path = landing_path(obs, "closing")
    for k, some in enumerate((F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0)):
        obs.where(some).write.parquet(f"{path}/in/{k}")
        arrivals = ingest.read_arrivals(spark, f"{path}/in/*", obs.schema, files_per_batch=1_000_000)
        closing.close_days(arrivals, f"{path}/out", f"{path}/state", "pm25", "1 day").awaitTermination()
    late = closing.late_rows(spark, f"{path}/out").groupBy(
        "station", F.date_trunc("day", F.col("time").cast("timestamp_ltz")).cast("timestamp_ntz").alias("start")).agg(F.count("*").alias("n_late"))
    closed = closing.closed_days(spark, f"{path}/out").join(late, ["station", "start"], "left")
    return rounded(closed.select(F.col("station").alias("station_id"), "start", "mean", "n", F.coalesce("n_late", F.lit(0)).alias("n_late")))


BY_STATION = StoredSummary(["station_id"], ["pm25"])
BY_DAY = StoredSummary((), ["pm25"], {"stations": ["station_id"], "cells": ["lat", "lon"]})


def _stored(obs, summary: StoredSummary, label: str):
    """The parts of three loads, the second of which is tried twice."""
    path = landing_path(obs, label)
    for k in (0, 1, 1, 2):
        summary.add(obs.where(F.pmod("event_id", F.lit(3)) == k), path, "load", k)
    return summary.read(obs.sparkSession, path, obs.schema)


@part.query("obs", sql="""
    SELECT station_id, count(*) AS rows, min(time) AS start, max(time) AS end, count(pm25) AS pm25_n,
           round(avg(pm25), 6) AS pm25_mean, min(pm25) AS pm25_min, max(pm25) AS pm25_max
    FROM obs GROUP BY station_id""")
def stored_by_station(obs):
    return rounded(BY_STATION.merged(_stored(obs, BY_STATION, "stations")))


@part.query("obs", sql="""
    SELECT CAST(time AS DATE) AS day, count(*) AS rows, min(time) AS start, max(time) AS end,
           count(pm25) AS pm25_n, round(avg(pm25), 6) AS pm25_mean, min(pm25) AS pm25_min, max(pm25) AS pm25_max,
           count(DISTINCT station_id) AS stations, count(DISTINCT (lat, lon)) AS cells, true AS sketch_holds
    FROM obs GROUP BY 1""")
def stored_by_day(obs):
    """The sketches are held against exact numbers, which are what is returned."""
    parts = _stored(obs, BY_DAY, "days")
    exact = obs.groupBy(F.to_date("time").alias("day")).agg(
        F.count_distinct("station_id").alias("n_stations"), F.count_distinct("lat", "lon").alias("n_cells"))
    both = BY_DAY.merged(parts, ["day"]).join(exact, "day")
    holds = [F.abs(F.col(c) - F.col(f"n_{c}")) <= 0.08 * F.col(f"n_{c}") for c in ("stations", "cells")]
    return rounded(both.select(
        "day", "rows", "start", "end", "pm25_n", "pm25_mean", "pm25_min", "pm25_max", F.col("n_stations").alias("stations"),
        F.col("n_cells").alias("cells"), (holds[0] & holds[1]).alias("sketch_holds")))


def stream_score(spark: SparkSession, sf_dir: str):
    prepare(spark)
    model, ready = fitted(spark, sf_dir)
    arrivals = spark_view(spark, sf_dir, "features", events=_event_stream(spark, sf_dir)).withColumn(
        "day_of_year", F.dayofyear("time")
    )
    scored = ingest.score_stream(arrivals, model, PARAMS).select(
        "event_id", "station_id", "time", "predicted_pm25", "date"
    )
    kept = _run(scored, "scored", ["date"])
    return kept.select("event_id", "station_id", "time", "date", in_range("predicted_pm25", ready).alias("in_range"))


ORACLE_FIRSTS = part.oracles["ingest_dedup"]
QUERIES = {
    **part.queries, "ingest_stream": ingest_stream, "stream_24h": stream_24h, "stream_score": stream_score,
    "closed_days": closed_days,
}
ORACLES = {
    **part.oracles,
    # A row is scored where no feature is missing.
    "stream_score": with_views(
        f"""
        SELECT event_id, station_id, time, CAST(time AS DATE) AS date,
               {' AND '.join(f'{f} IS NOT NULL' for f in FEATURES if f != 'day_of_year')} AS in_range
        FROM features""", ("features",)
    ),
    "ingest_stream": ORACLE_FIRSTS,
    "closed_days": with_views(
        """
        , marks AS (SELECT max(time) FILTER (event_id % 10 <> 0) - INTERVAL '1' DAY AS early, max(time) - INTERVAL '1' DAY AS last FROM obs),
        dated AS (SELECT *, CAST(date_trunc('day', time) AS TIMESTAMP) AS start FROM obs),
        placed AS (SELECT d.*, start + INTERVAL '1' DAY <= early AS closed_early, event_id % 10 <> 0 AS first FROM dated d, marks
                   WHERE start + INTERVAL '1' DAY <= last)
        SELECT station_id, start, round(avg(pm25) FILTER (first OR NOT closed_early), 6) AS mean,
               count(pm25) FILTER (first OR NOT closed_early) AS n, count(*) FILTER (closed_early AND NOT first) AS n_late
        FROM placed GROUP BY 1, 2 HAVING count(*) FILTER (first OR NOT closed_early) > 0""", ("obs",)
    ),
    "stream_24h": with_views(
        """
        SELECT station_id, CAST(date_trunc('day', time) AS TIMESTAMP) AS start, round(avg(pm25), 6) AS mean,
               count(pm25) AS n FROM obs GROUP BY 1, 2""", ("obs",)
    ),
}
