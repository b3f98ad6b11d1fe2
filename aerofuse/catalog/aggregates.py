"""Reshaping, error metrics and summaries."""

from __future__ import annotations


from aerofuse.catalog.binding import Part, rounded
from aerofuse.operators import quality, reshape, summaries
from aerofuse.sources import union_all

part = Part()
FEATURE_COLUMNS = ("aod", "temperature", "humidity", "wind_speed", "boundary_layer_height")


@part.query("obs_long", sql="""
    SELECT time, station_id, arg_max(value, event_id) FILTER (WHERE parameter = 'pm25') AS pm25,
           arg_max(value, event_id) FILTER (WHERE parameter = 'pm10') AS pm10
    FROM obs_long WHERE parameter IN ('pm25', 'pm10') GROUP BY time, station_id""")
def pivot_pm(obs_long):
    return reshape.pivot_measurements(obs_long, ["time", "station_id"], "event_id")


RMSE = "sqrt(avg(power(y - p, 2)))"
MAE = "avg(abs(y - p))"
R2 = "1 - sum(power(y - p, 2)) / (var_pop(y) * count(y))"


@part.query("scored", sql=f"SELECT round({RMSE}, 6) AS rmse FROM scored")
def metric_rmse(scored):
    return rounded(scored.agg(summaries.rmse("y", "p").alias("rmse")))


@part.query("scored", sql=f"SELECT round({MAE}, 6) AS mae FROM scored")
def metric_mae(scored):
    return rounded(scored.agg(summaries.mae("y", "p").alias("mae")))


@part.query("scored", sql=f"SELECT round({R2}, 6) AS r2 FROM scored")
def metric_r2(scored):
    return rounded(scored.agg(summaries.r2("y", "p").alias("r2")))


@part.query("scored", sql=f"""
    SELECT station_id, round({RMSE}, 6) AS rmse, round({MAE}, 6) AS mae, round({R2}, 6) AS r2
    FROM scored GROUP BY station_id""")
def metrics_by_station(scored):
    return rounded(summaries.regression_metrics(scored, "y", "p", by=["station_id"]))


@part.query("features", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 6) AS missing_fraction, "
    f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) > 0.4 AS exceeds FROM features" for c in FEATURE_COLUMNS))
def missing_fraction(features):
    return rounded(quality.missing_fraction(features, FEATURE_COLUMNS, 0.4))


@part.query("features", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM features" for c in FEATURE_COLUMNS))
def column_median(features):
    return rounded(quality.column_medians(features, FEATURE_COLUMNS))


@part.query("obs", sql="""
    SELECT count(*) AS rows, min(time) AS start, max(time) AS end, count(DISTINCT station_id) AS stations FROM obs""")
def fetch_summary(obs):
    return summaries.fetch_summary(obs)


@part.query("obs", sql="""
    SELECT 'station' AS scope, station_id, count(*) AS rows, min(time) AS start, max(time) AS end,
           count(DISTINCT station_id) AS stations, NULL AS columns FROM obs GROUP BY station_id
    UNION ALL
    SELECT 'all', NULL, count(*), min(time), max(time), count(DISTINCT station_id),
           'event_id, station_id, lat, lon, time, pm25' FROM obs""")
def fetch_by_station(obs):
    return summaries.fetch_by_station(obs)


@part.query("weather", sql="""
    SELECT count(DISTINCT o_orderkey) AS stations, min(time) AS start, max(time) AS end,
           min(temperature) AS temperature_min, max(temperature) AS temperature_max,
           round(avg(temperature), 6) AS temperature_mean, min(wind_speed) AS wind_speed_min,
           max(wind_speed) AS wind_speed_max, round(avg(wind_speed), 6) AS wind_speed_mean
    FROM weather""")
def source_summary(weather):
    return rounded(summaries.source_summary(weather, ["temperature", "wind_speed"], station="o_orderkey"))


@part.query("obs_long", sql="SELECT parameter, count(*) AS n FROM obs_long GROUP BY parameter")
def value_counts(obs_long):
    return summaries.value_counts(obs_long, "parameter")


@part.query("aerosol", sql="SELECT count(*) AS cells FROM (SELECT DISTINCT lat, lon FROM aerosol)")
def distinct_cells(aerosol):
    return summaries.distinct_cells(aerosol)


@part.query("scored", sql="""
    SELECT count(*) AS predictions, round(avg(p), 6) AS mean, max(p) AS max FROM scored""")
def log_summary(scored):
    return rounded(summaries.log_summary(scored, "p"))


@part.query("scored", sql="SELECT min(p) AS min, max(p) AS max, round(avg(p), 6) AS mean FROM scored")
def score_summary(scored):
    return rounded(summaries.score_summary(scored, "p"))


@part.query("obs", sql="""
    , means AS (
        SELECT station_id, CAST(date_trunc('day', time) AS TIMESTAMP) AS start, '24h' AS period, avg(pm25) AS mean, 60e0 AS "limit"
        FROM obs GROUP BY 1, 2
        UNION ALL
        SELECT station_id, CAST(date_trunc('year', time) AS TIMESTAMP), 'annual', avg(pm25), 40e0 FROM obs GROUP BY 1, 2)
    SELECT station_id, start, period, round(mean, 6) AS mean, "limit" FROM means WHERE mean > "limit\"""")
def limit_exceedance(obs):
    return rounded(summaries.limit_exceedance(obs))


@part.query("features", sql="""
    SELECT count(*) FILTER (WHERE pm25 IS NULL) AS dropped_rows, count(*) AS rows FROM features""")
def dropped_rows(features):
    return quality.dropped_rows(features, "pm25")


@part.query("obs", "scored", sql="""
    SELECT event_id, station_id, pm25, NULL AS p FROM obs
    UNION ALL SELECT event_id, station_id, NULL, p FROM scored""")
def union_sources(obs, scored):
    return union_all([obs.select("event_id", "station_id", "pm25"), scored.select("event_id", "station_id", "p")])


@part.query("obs_long", sql="SELECT DISTINCT station_id, lat, lon, parameter FROM obs_long")
def distinct_rows(obs_long):
    return obs_long.select("station_id", "lat", "lon", "parameter").distinct()


QUERIES, ORACLES = part.queries, part.oracles
