"""Joins in space and time."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from aerofuse.catalog.binding import Part, rounded
from aerofuse.operators.asof import asof_join
from aerofuse.operators.reshape import latest_measurements, merge_pm10
from aerofuse.operators.spatial import coverage_gaps, grid_skeleton, nearest_within, place_of, regrid_mean
from aerofuse.operators.update import match_update as update_near
from aerofuse.params import FusionParams
from aerofuse.plans import fusion
from aerofuse.plans.preprocess import load_measured
from aerofuse.session import shared_folder

part = Part()
WIDE = FusionParams(aerosol_radius_km=50.0, weather_radius_km=50.0)
AEROSOL_ORDER = ("aod", "cloud_fraction", "l_orderkey", "l_linenumber")
WEATHER_ORDER = ("temperature", "humidity", "wind_speed", "boundary_layer_height", "o_orderkey")


def _distance(a: str, b: str) -> str:
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) "
        f"* cos(radians({b}.lat)) * power(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
    )


def _nearest_sql(left: str, right: str, radius: float, name: str) -> str:
    """Brute-force nearest place, as common table expressions ending in ``name``."""
    return f"""
    {name}_pairs AS (
        SELECT a.lat, a.lon, b.lat AS cell_lat, b.lon AS cell_lon, {_distance('a', 'b')} AS d
        FROM (SELECT DISTINCT lat, lon FROM {left}) a, (SELECT DISTINCT lat, lon FROM {right}) b),
    {name} AS (
        SELECT lat, lon, cell_lat, cell_lon, d AS distance_km FROM (
            SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY round(d, 6), cell_lat, cell_lon) AS rn
            FROM {name}_pairs WHERE d <= {radius}) WHERE rn = 1)"""


def _fuse_sql(left: str, grid: str, values: tuple[str, ...], order: tuple[str, ...], hours: int, name: str,
              sites: str | None = None, radius: float = 50.0) -> str:
    """Nearest cell, then nearest time in that cell, by ranking all pairs."""
    picked = ", ".join(values)
    ranked = ", ".join(f"g.{c}" for c in order)
    return f"""{_nearest_sql(sites or left, grid, radius, name + '_site')},
    {name}_best AS (
        SELECT event_id, {picked} FROM (
            SELECT o.event_id, {', '.join(f'g.{v}' for v in values)},
                   row_number() OVER (PARTITION BY o.event_id
                       ORDER BY abs(epoch_us(g.time) - epoch_us(o.time)), g.time, {ranked}) AS rn
            FROM {left} o JOIN {name}_site s ON o.lat = s.lat AND o.lon = s.lon
            JOIN {grid} g ON g.lat = s.cell_lat AND g.lon = s.cell_lon
                AND abs(epoch_us(g.time) - epoch_us(o.time)) <= {hours} * 3600000000) WHERE rn = 1),
    {name} AS (
        SELECT o.*, {picked} FROM {left} o JOIN {name}_site s ON o.lat = s.lat AND o.lon = s.lon
        LEFT JOIN {name}_best b ON o.event_id = b.event_id)"""


@part.query("stations", "aerosol", sql=f"""
    , {_nearest_sql('stations', 'aerosol', 50.0, 'hit')}
    SELECT lat, lon, cell_lat, cell_lon, round(distance_km, 6) AS distance_km FROM hit""")
def spatial_nn(stations, aerosol):
    return rounded(nearest_within(stations, aerosol, 50.0, prefix="cell_"))


@part.query("obs", "scored", sql="""
    , hit AS (
        SELECT o.event_id, r.p, r.y, row_number() OVER (PARTITION BY o.event_id
            ORDER BY abs(epoch_us(r.time) - epoch_us(o.time)), r.time, r.event_id) AS rn
        FROM obs o JOIN scored r ON r.station_id = o.station_id
            AND abs(epoch_us(r.time) - epoch_us(o.time)) <= 3600000000)
    SELECT o.event_id, o.station_id, o.time, h.p, h.y
    FROM obs o LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h ON o.event_id = h.event_id""")
def asof_nearest(obs, scored):
    hits = asof_join(obs, scored, values=("p", "y"), tolerance=timedelta(hours=1), by=("station_id",),
                     order=("event_id",))
    return hits.select("event_id", "station_id", "time", "p", "y")


@part.query("obs", "aerosol", sql="""
    , instants AS (
        SELECT time, aod, cloud_fraction FROM (
            SELECT *, row_number() OVER (PARTITION BY time ORDER BY aod, cloud_fraction, l_orderkey, l_linenumber) AS rn
            FROM aerosol) WHERE rn = 1),
    hit AS (
        SELECT o.event_id, g.aod, g.cloud_fraction, row_number() OVER (PARTITION BY o.event_id
            ORDER BY abs(epoch_us(g.time) - epoch_us(o.time)), g.time) AS rn
        FROM obs o JOIN instants g ON abs(epoch_us(g.time) - epoch_us(o.time)) <= 3600000000)
    SELECT o.event_id, o.time, h.aod, h.cloud_fraction
    FROM obs o LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h ON o.event_id = h.event_id""")
def asof_unkeyed(obs, aerosol):
    hits = asof_join(obs, aerosol, values=("aod", "cloud_fraction"), tolerance=timedelta(hours=1),
                     order=AEROSOL_ORDER)
    return hits.select("event_id", "time", "aod", "cloud_fraction")


@part.query("obs", "aerosol", sql=f"""
    , {_fuse_sql('obs', 'aerosol', fusion.AEROSOL_VALUES, AEROSOL_ORDER, 6, 'fused')}
    SELECT event_id, station_id, lat, lon, time, pm25, round(aod, 6) AS aod,
           round(cloud_fraction, 6) AS cloud_fraction FROM fused""")
def fuse_aerosol(obs, aerosol):
    return rounded(fusion.fuse_aerosol(obs, aerosol, WIDE, order=AEROSOL_ORDER))


@part.query("obs", "weather", sql=f"""
    , {_fuse_sql('obs', 'weather', fusion.WEATHER_VALUES, WEATHER_ORDER, 12, 'fused')}
    SELECT event_id, station_id, lat, lon, time, pm25, temperature, humidity, wind_speed,
           boundary_layer_height FROM fused""")
def fuse_weather(obs, weather):
    return rounded(fusion.fuse_weather(obs, weather, WIDE, order=WEATHER_ORDER))


FUSE_ALL_SQL = f"""
    , {_fuse_sql('obs', 'aerosol', fusion.AEROSOL_VALUES, AEROSOL_ORDER, 6, 'with_aerosol')},
    {_fuse_sql('with_aerosol', 'weather', fusion.WEATHER_VALUES, WEATHER_ORDER, 12, 'fused')}"""


@part.query("obs", "aerosol", "weather", sql=f"""{FUSE_ALL_SQL}
    SELECT event_id, station_id, lat, lon, time, pm25, round(aod, 6) AS aod, round(cloud_fraction, 6) AS cloud_fraction,
           temperature, humidity, wind_speed, boundary_layer_height FROM fused""")
def fuse_all(obs, aerosol, weather):
    return rounded(fusion.fuse(obs, aerosol, weather, WIDE, aerosol_order=AEROSOL_ORDER, weather_order=WEATHER_ORDER))


@part.query("obs", "aerosol", "weather", sql=f"""
    , some_obs AS (SELECT * FROM obs WHERE time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'),
    sound_aerosol AS (
        SELECT * FROM aerosol WHERE l_orderkey % 10 <> 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
            AND aod BETWEEN 0 AND 5 AND cloud_fraction BETWEEN 0 AND 1
            AND time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'),
    sound_weather AS (
        SELECT * FROM weather WHERE o_orderkey % 13 <> 0 AND temperature BETWEEN 200 AND 330
            AND humidity BETWEEN 0 AND 100 AND wind_speed >= 0 AND boundary_layer_height BETWEEN 0 AND 3000
            AND time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'),
    {_fuse_sql('some_obs', 'sound_aerosol', fusion.AEROSOL_VALUES, AEROSOL_ORDER, 6, 'with_aerosol')},
    {_fuse_sql('with_aerosol', 'sound_weather', fusion.WEATHER_VALUES, WEATHER_ORDER, 12, 'fused')}
    SELECT event_id, station_id, lat, lon, time, pm25, round(aod, 6) AS aod, round(cloud_fraction, 6) AS cloud_fraction,
           temperature, humidity, wind_speed, boundary_layer_height FROM fused""")
def fuse_sound(obs, aerosol, weather):
    """A period, with rows that break rules planted in both grids; they are set aside."""
    bad_air = aerosol.withColumn("aod", F.when(F.col("l_orderkey") % 10 == 0, F.lit(-1.0)).otherwise(F.col("aod")))
    bad_met = weather.withColumn("humidity", F.when(F.col("o_orderkey") % 13 == 0, F.lit(140.0)).otherwise(F.col("humidity")))
    rejected = f"{shared_folder(obs.sparkSession)}/rejected-{uuid.uuid4().hex}"
    return rounded(fusion.fuse_period(
        obs, bad_air, bad_met, datetime(2024, 1, 3), datetime(2024, 1, 25), params=WIDE, on_invalid="split",
        rejected=rejected, aerosol_order=AEROSOL_ORDER, weather_order=WEATHER_ORDER,
    ))


UPDATE_SQL = """
    , {name}_hit AS (
        SELECT m.event_id AS m_id, m.pm10_id, m.pm25 AS m25, m.pm10 AS m10, t.event_id,
               row_number() OVER (PARTITION BY m.event_id, m.pm10_id ORDER BY t.time, t.event_id) AS rn
        FROM {observed} m JOIN {targets} t ON abs(epoch_us(m.time) - epoch_us(t.time)) < 3600000000
            AND abs(m.lat - t.lat) < 0.1 AND abs(m.lon - t.lon) < 0.1),
    {name}_new AS (
        SELECT event_id, arg_max(m25, (m_id, coalesce(pm10_id, -1))) AS m25,
               arg_max(m10, (m_id, coalesce(pm10_id, -1))) FILTER (WHERE m10 IS NOT NULL) AS m10
        FROM {name}_hit WHERE rn = 1 GROUP BY event_id)"""
WIDE_MEASURED_SQL = """
    , wide AS (
        SELECT a.event_id, b.event_id AS pm10_id, a.time, a.lat, a.lon, a.value AS pm25, b.value AS pm10
        FROM measured a LEFT JOIN (SELECT * FROM measured WHERE parameter = 'pm10') b
            ON a.time = b.time AND a.lat = b.lat AND a.lon = b.lon
        WHERE a.parameter = 'pm25')"""


@part.query("station_rows", "measured", sql=f"""{WIDE_MEASURED_SQL}
    {UPDATE_SQL.format(name='u', observed='wide', targets='station_rows')}
    SELECT t.event_id, t.station_id, t.time, t.lat, t.lon,
           CASE WHEN n.event_id IS NULL THEN t.pm25 ELSE n.m25 END AS pm25, coalesce(n.m10, t.pm10) AS pm10
    FROM station_rows t LEFT JOIN u_new n ON t.event_id = n.event_id""")
def match_update(station_rows, measured):
    wide = latest_measurements(measured, "event_id")
    return update_near(
        station_rows, wide, target_key="event_id", observation_order=("event_id", "pm10_event_id")
    )


@part.query("station_rows", "measured", "aerosol", "weather", sql=f"""{WIDE_MEASURED_SQL},
    {_fuse_sql('station_rows', 'aerosol', fusion.AEROSOL_VALUES, AEROSOL_ORDER, 6, 'with_aerosol')},
    {_fuse_sql('with_aerosol', 'weather', fusion.WEATHER_VALUES, WEATHER_ORDER, 12, 'fused', radius=150.0)}
    {UPDATE_SQL.format(name='u', observed='wide', targets='fused')}
    SELECT t.event_id, t.station_id, t.time, t.lat, t.lon,
           CASE WHEN n.event_id IS NULL THEN t.pm25 ELSE n.m25 END AS pm25, coalesce(n.m10, t.pm10) AS pm10,
           round(aod, 6) AS aod, round(cloud_fraction, 6) AS cloud_fraction, temperature, humidity, wind_speed,
           boundary_layer_height, CAST(dayofyear(t.time) AS INTEGER) AS day_of_year
    FROM fused t LEFT JOIN u_new n ON t.event_id = n.event_id""")
def real_load(station_rows, measured, aerosol, weather):
    return rounded(
        load_measured(
            measured, station_rows, aerosol, weather, row_key="event_id", measurement_key="event_id",
            aerosol_order=AEROSOL_ORDER, weather_order=WEATHER_ORDER,
        )
    )


@part.query("obs_long", sql="""
    SELECT a.event_id, a.station_id, a.time, a.value AS pm25, b.value AS pm10
    FROM obs_long a LEFT JOIN (SELECT * FROM obs_long WHERE parameter = 'pm10') b
        ON a.time = b.time AND a.lat = b.lat AND a.lon = b.lon
    WHERE a.parameter = 'pm25'""")
def pm_left_merge(obs_long):
    return merge_pm10(obs_long).select("event_id", "station_id", "time", "pm25", "pm10")


@part.query("obs_long", sql="""
    SELECT a.event_id, a.station_id, a.time, a.value AS pm25, b.value AS pm10
    FROM obs_long a LEFT JOIN (
        SELECT station_id, time, arg_max(value, event_id) AS value FROM obs_long WHERE parameter = 'pm10'
        GROUP BY station_id, time) b ON a.station_id = b.station_id AND a.time = b.time
    WHERE a.parameter = 'pm25'""")
def pm_time_merge(obs_long):
    """One coarse reading per station and instant, the last, so that no fine reading is repeated."""
    on = ["station_id", "time"]
    coarse = obs_long.where("parameter = 'pm10'").groupBy(*on).agg(F.max_by("value", "event_id").alias("value"))
    fine = obs_long.where("parameter = 'pm25'").select(*on, "parameter", "value", "event_id")
    both = fine.unionByName(coarse.withColumn("parameter", F.lit("pm10")), allowMissingColumns=True)
    return merge_pm10(both, on=on).select("event_id", "station_id", "time", "pm25", "pm10")


def _daily_grid(aerosol):
    """Daily skeleton over the period of the data, and the days and cells that are observed."""
    observed = aerosol.select("lat", "lon", F.date_trunc("day", "time").cast("timestamp_ntz").alias("time"))
    start, end = observed.agg(F.min("time"), F.max("time")).first()
    skeleton = grid_skeleton(
        aerosol.sparkSession, start=start, end=end, lat_min=8.0, lat_max=35.0, lon_min=68.0, lon_max=97.0, step=1.0,
        digits=1,
    )
    return skeleton, observed


SKELETON_SQL = """
    , days AS (SELECT min(date_trunc('day', time)) AS first_day, max(date_trunc('day', time)) AS last_day FROM aerosol),
    skeleton AS (
        SELECT CAST(first_day + d * INTERVAL '1' DAY AS TIMESTAMP) AS time, CAST(y AS DOUBLE) AS lat, CAST(x AS DOUBLE) AS lon
        FROM days, range(8, 36) la(y), range(68, 98) lo(x), range(0, 1000) t(d)
        WHERE first_day + d * INTERVAL '1' DAY <= last_day)"""


@part.query("aerosol", name="grid_skeleton", sql=f"{SKELETON_SQL} SELECT time, lat, lon FROM skeleton")
def daily_skeleton(aerosol):
    return _daily_grid(aerosol)[0]


@part.query("aerosol", name="coverage_gaps", sql=f"""{SKELETON_SQL}
    SELECT s.time, s.lat, s.lon FROM skeleton s WHERE NOT EXISTS (
        SELECT 1 FROM aerosol a WHERE CAST(date_trunc('day', a.time) AS TIMESTAMP) = s.time
            AND a.lat = s.lat AND a.lon = s.lon)""")
def days_without_data(aerosol):
    return coverage_gaps(*_daily_grid(aerosol))


@part.query("obs_long", "stations", sql="""
    SELECT o.event_id, o.station_id, coalesce(s.lat, 20.0) AS lat, coalesce(s.lon, 75.0) AS lon
    FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'new-' || station_id ELSE station_id END AS station_id FROM obs_long) o
    LEFT JOIN stations s ON o.station_id = s.station_id""")
def lookup_default(obs_long, stations):
    # Every fourth measurement names a station that the lookup does not have.
    renamed = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("new-"), "station_id")).otherwise(F.col("station_id"))
    return place_of(obs_long.select("event_id", renamed.alias("station_id")), stations, "station_id", 20.0, 75.0)


@part.query("obs", sql="""
    SELECT round(round(lat - 8) + 8, 1) AS lat, round(round(lon - 68) + 68, 1) AS lon, time,
           round(avg(pm25), 6) AS pm25, count(*) AS n
    FROM obs GROUP BY 1, 2, 3""", name="regrid_mean")
def coarse_means(obs):
    return rounded(regrid_mean(obs, ["pm25"], lat_origin=8.0, lon_origin=68.0, step=1.0, digits=1))


QUERIES, ORACLES = part.queries, part.oracles
