"""Scalar functions over columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerofuse import functions
from aerofuse.catalog.binding import Part
from aerofuse.catalog.scans import CATEGORY_SQL, INDEX_SQL
from aerofuse.functions.airquality import advice_table
from aerofuse.operators import reshape
from aerofuse.operators.spatial import assign_to_grid

part = Part()


@part.query("obs_long", sql="""
    SELECT event_id, round(2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(20.0 - lat) / 2), 2)
        + cos(radians(lat)) * cos(radians(20.0)) * power(sin(radians(75.0 - lon) / 2), 2)))), 6) AS km
    FROM obs_long""")
def haversine(obs_long):
    km = functions.haversine_km(F.col("lat"), F.col("lon"), F.lit(20.0), F.lit(75.0))
    return obs_long.select("event_id", F.round(km, 6).alias("km"))


@part.query("orders", sql="SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year FROM orders")
def day_of_year(orders):
    return orders.select("o_orderkey", functions.day_of_year(F.col("o_orderdate")).alias("day_of_year"))


@part.query("orders", sql="""
    SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (5, 6) THEN 'summer' WHEN month(o_orderdate) IN (7, 8, 9)
        THEN 'monsoon' WHEN month(o_orderdate) IN (11, 12, 1, 2) THEN 'winter' ELSE 'other' END AS season
    FROM orders""")
def season_band(orders):
    return orders.select("o_orderkey", functions.season(F.col("o_orderdate")).alias("season"))


@part.query("events", sql="""
    SELECT event_id, CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(month(ts) AS INTEGER) AS month_of_year,
           CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events""")
def time_features(events):
    return functions.with_time_features(events, "ts").select("event_id", "day_of_year", "month_of_year", "hour_of_day")


@part.query("raw_weather", sql="""
    SELECT o_orderkey, round(sqrt(u_wind * u_wind + v_wind * v_wind), 6) AS wind_speed FROM raw_weather""")
def wind_speed(raw_weather):
    speed = functions.wind_speed(F.col("u_wind"), F.col("v_wind"))
    return raw_weather.withColumn("wind_speed", F.round(speed, 6)).drop("u_wind", "v_wind").select(
        "o_orderkey", "wind_speed"
    )


@part.query("raw_weather", sql="""
    SELECT o_orderkey, round(least(greatest(specific_humidity * 1013.25 / 0.622 / (6.112 * power(2.718281828,
        17.27 * (temperature - 273.15) / (237.7 + (temperature - 273.15)))) * 100, 0), 100), 6) AS humidity
    FROM raw_weather""")
def relative_humidity(raw_weather):
    humidity = functions.relative_humidity(F.col("specific_humidity"), F.col("temperature"))
    return raw_weather.select("o_orderkey", F.round(humidity, 6).alias("humidity"))


@part.query("features", sql="""
    SELECT event_id, CASE WHEN aod IS NULL THEN NULL ELSE least(greatest(aod, 0.05), 2.5) END AS aod FROM features""")
def clip(features):
    return features.select("event_id", functions.clip(F.col("aod"), 0.05, 2.5).alias("aod"))


@part.query("obs_long", sql="""
    SELECT 'measured' AS origin, a.event_id, a.value AS pm25, b.value AS pm10
    FROM obs_long a LEFT JOIN (SELECT * FROM obs_long WHERE parameter = 'pm10') b
        ON a.time = b.time AND a.lat = b.lat AND a.lon = b.lon
    WHERE a.parameter = 'pm25'
    UNION ALL SELECT 'estimated', event_id, value, value * 1.5 FROM obs_long WHERE parameter = 'pm25'""")
def pm10_estimate(obs_long):
    """Both branches over all rows: with the coarse readings, and with their parameter under a name that is not coarse."""
    unknown = obs_long.withColumn("parameter", F.when(F.col("parameter") == "pm10", "dust").otherwise(F.col("parameter")))
    measured, estimated = reshape.merge_pm10(obs_long), reshape.merge_pm10(unknown)
    return measured.withColumn("origin", F.lit("measured")).unionByName(
        estimated.withColumn("origin", F.lit("estimated"))).select("origin", "event_id", "pm25", "pm10")


@part.query("scored", sql=f"SELECT event_id, y, {CATEGORY_SQL.format('y')} AS category FROM scored")
def aqi_category(scored):
    return scored.select("event_id", "y", functions.aqi_category(F.col("y")).alias("category"))


@part.query("scored", sql=f"SELECT event_id, p, {INDEX_SQL.format('p')} AS aqi FROM scored")
def aqi_index(scored):
    return scored.select("event_id", "p", functions.aqi_index(F.col("p")).alias("aqi"))


@part.query("scored", sql=f"""
    , banded AS (SELECT event_id, {CATEGORY_SQL.format('y')} AS category FROM scored)
    SELECT event_id, category,
        CASE substr(category, 3) WHEN 'GOOD' THEN 'good' WHEN 'MODERATE' THEN 'moderate'
            WHEN 'UNHEALTHY FOR SENSITIVE GROUPS' THEN 'unhealthy' WHEN 'UNHEALTHY' THEN 'very_unhealthy'
            ELSE 'hazardous' END AS color,
        CASE substr(category, 3) WHEN 'GOOD' THEN 'Air quality is satisfactory. Enjoy your outdoor activities!'
            WHEN 'MODERATE' THEN 'Sensitive individuals should reduce prolonged outdoor exertion.'
            WHEN 'UNHEALTHY FOR SENSITIVE GROUPS' THEN 'Members of sensitive groups should avoid outdoor activities.'
            WHEN 'UNHEALTHY' THEN 'Everyone should avoid outdoor activities.'
            ELSE 'Everyone should avoid ALL outdoor exertion.' END AS advice
    FROM banded""")
def aqi_advice(scored):
    banded = scored.select("event_id", functions.aqi_category(F.col("y")).alias("category"))
    # The lookup has five rows.
    return banded.join(F.broadcast(advice_table(scored.sparkSession)), "category", "left")


@part.query("scored", sql="SELECT event_id, round(p - 25, 6) AS delta FROM scored")
def delta_to_ref(scored):
    return scored.select("event_id", F.round(functions.delta_to_reference(F.col("p")), 6).alias("delta"))


@part.query("obs_long", sql="""
    SELECT event_id, round(round((lat - 8) / 25e-2) * 25e-2 + 8, 2) AS lat,
           round(round((lon - 68) / 25e-2) * 25e-2 + 68, 2) AS lon FROM obs_long""")
def grid_snap(obs_long):
    snapped = assign_to_grid(obs_long, lat_origin=8.0, lon_origin=68.0, step=0.25, digits=2)
    return snapped.select("event_id", "lat", "lon")


QUERIES, ORACLES = part.queries, part.oracles
