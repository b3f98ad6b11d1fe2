"""Sources, sinks and validation."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse import sources
from aerofuse.catalog.binding import Part, rounded
from aerofuse.functions import aqi_category, aqi_index, parse_number, parse_time, station_key
from aerofuse.operators.quality import outlier_filter as drop_outliers
from aerofuse.params import FEATURES
from aerofuse.session import shared_folder
from aerofuse.sources import schemas

part = Part()

BOX_FILE_ROWS = 4_000  # small, so that a test table has some files; production uses the library's default


def landing_path(df, label: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"


@part.query("features", sql=f"""
    SELECT {', '.join(FEATURES[:-1])}, CAST(dayofyear(time) AS INTEGER) AS day_of_year, pm25, event_id FROM features""")
def read_unified(features):
    schema = T.StructType([*schemas.UNIFIED.fields, T.StructField("event_id", T.LongType())])
    path = landing_path(features, "unified")
    whole = features.withColumn("day_of_year", F.dayofyear("time"))
    sources.write_table(whole, path, "csv", columns=schema.names)
    return sources.read_unified(features.sparkSession, path, schema=schema)


@part.query("obs_long", sql="""
    SELECT station_id, lat, lon, time, parameter, value FROM obs_long""")
def long_scan(obs_long):
    path = landing_path(obs_long, "long")
    file = obs_long.select(
        (F.col("event_id") % 10).cast("string").alias("location_id"),
        F.col("station_id").alias("location_name"),
        "parameter",
        "value",
        F.lit("µg/m³").alias("unit"),
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetimeUtc"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
    )
    sources.write_table(file, path, "csv")
    return sources.long_measurements(
        sources.read_table(obs_long.sparkSession, path, schemas.LONG_MEASUREMENT, "csv")
    )


@part.query("obs_long", sql="""
    SELECT 'City' || (event_id % 4) || '-' || CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 10 AS VARCHAR)
               ELSE station_id END AS station_id,
           'City' || (event_id % 4) AS city, lat, lon, time, lower(parameter) AS parameter, value,
           CAST(1 AS INTEGER) AS results_position
    FROM obs_long WHERE lower(parameter) LIKE '%pm%' AND event_id % 13 <> 0""")
def json_flatten(obs_long):
    path = landing_path(obs_long, "landing")
    moment = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def entry(parameter, value):
        return F.struct(
            parameter.alias("parameter"), value.alias("value"), F.struct(moment.alias("utc")).alias("date")
        )

    unreadable = F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col("value").cast("string"))
    documents = obs_long.select(
        F.concat(F.lit("City"), (F.col("event_id") % 4).cast("string")).alias("city"),
        F.struct(
            (F.col("event_id") % 10).alias("id"),
            F.when(F.col("event_id") % 3 != 0, F.col("station_id")).alias("name"),
            F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("coordinates"),
        ).alias("location"),
        F.array(entry(F.lit("humidity"), F.lit("50")), entry(F.col("parameter"), unreadable)).alias("results"),
    )
    sources.write_table(documents, path, "json")
    return sources.flatten_landing(sources.read_table(obs_long.sparkSession, path, schemas.LANDING, "json"))


def _by_day(df, time: str, where):
    """The table laid down in folders by day, and what ``where`` keeps of it."""
    path = landing_path(df, "days")
    sources.append_log(df, path, time)
    return sources.read_table(df.sparkSession, path, df.schema.add("date", "date"), where=where)


@part.query("events", sql="""
    SELECT event_id, ts, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 06:00:00'""")
def date_range_scan(events):
    wanted = sources.within_dates(datetime(2024, 1, 5), datetime(2024, 1, 12, 6), "ts", day="date")
    return _by_day(events, "ts", wanted).select("event_id", "ts", "value")


@part.query("obs", "stations", sql="""
    SELECT event_id, station_id, time, pm25 FROM obs
    WHERE station_id IN (SELECT station_id FROM stations WHERE nation_key < 12)""")
def station_semi(obs, stations):
    wanted = stations.where("nation_key < 12")
    return sources.only_stations(obs, wanted).select("event_id", "station_id", "time", "pm25")


@part.query("aerosol", sql="""
    SELECT lat, lon, time, l_orderkey, l_linenumber FROM aerosol
    WHERE lat BETWEEN 10 AND 20 AND lon BETWEEN 70 AND 80""")
def bbox_filter(aerosol):
    path = landing_path(aerosol, "places")
    sources.write_by_place(aerosol, path, BOX_FILE_ROWS)
    rows = sources.read_box(aerosol.sparkSession, path, aerosol.schema, lat_min=10, lat_max=20, lon_min=70, lon_max=80)
    return rows.select("lat", "lon", "time", "l_orderkey", "l_linenumber")


@part.query("obs_long", sql="""
    SELECT 'City' || (event_id % 4) AS city, count(*) AS n_rows, round(sum(value), 6) AS total, CAST(0 AS BIGINT) AS n_bad FROM obs_long GROUP BY 1
    UNION ALL SELECT 'City4', 0, NULL, 1""")
def unreadable_location(obs_long):
    """One location's file is no Parquet at all: every other row is read, and the file has an error row."""
    spark, path = obs_long.sparkSession, landing_path(obs_long, "failing")
    rows = obs_long.select("event_id", "value", F.concat(F.lit("City"), (F.col("event_id") % 4).cast("string")).alias("city"))
    sources.write_table(rows, f"{path}/good")
    spark.range(1).select(F.lit("<html>503 Service Unavailable</html>").alias("value")).write.text(f"{path}/bad/city=City4")
    kept, errors = sources.read_readable(spark, [f"{path}/good", f"{path}/bad"], rows.schema, pattern="*.{parquet,txt}")
    found = kept.groupBy("city").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))
    city = F.regexp_extract("file", "city=([^/]*)", 1).alias("city")
    failed = errors.groupBy(city).agg(F.lit(0).cast("long").alias("n_rows"), F.lit(None).cast("double").alias("total"), F.count("*").alias("n_bad"))
    return rounded(found.withColumn("n_bad", F.lit(0).cast("long")).unionByName(failed))


@part.query("obs_long", sql="""
    SELECT event_id, CASE WHEN event_id % 11 = 3 THEN 'type of value' WHEN event_id % 13 = 5 THEN '2 fields, not 3'
        WHEN event_id % 17 = 7 THEN '4 fields, not 3' ELSE 'sound' END AS verdict FROM obs_long""")
def broken_records(obs_long):
    """CSV lines with a value that is no number, a field too few or one too many, found by file, text and reason."""
    spark, path = obs_long.sparkSession, landing_path(obs_long, "broken")
    start = F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("station_id"))
    line = F.when(F.col("event_id") % 11 == 3, F.concat(start, F.lit(",n/a"))).when(F.col("event_id") % 13 == 5, start).when(
        F.col("event_id") % 17 == 7, F.concat(start, F.lit(",1.5,extra"))).otherwise(F.concat(start, F.lit(","), F.coalesce(F.col("value").cast("string"), F.lit(""))))
    obs_long.select(line.alias("line")).write.text(path)
    schema = T.StructType.fromDDL("event_id long, station_id string, value double")
    sound, broken = sources.read_records(spark, path, schema, header="false")
    return sound.select("event_id", F.lit("sound").alias("verdict")).unionByName(
        broken.select(F.split("record", ",")[0].cast("long").alias("event_id"), F.col("reason").alias("verdict")))


@part.query("orders", sql="""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE year(o_orderdate) * 12 + month(o_orderdate) BETWEEN 1994 * 12 + 11 AND 1996 * 12 + 2""")
def month_scan(orders):
    wanted = sources.within_months(date(1994, 11, 17), date(1996, 2, 3), "o_orderdate", day="date")
    path = landing_path(orders, "months")
    rows = orders.withColumn("date", F.trunc("o_orderdate", "month"))
    sources.write_table(rows, path, partition_by=["date"])
    return sources.read_table(orders.sparkSession, path, rows.schema, where=wanted).select("o_orderkey", "o_orderdate")


@part.query("obs_long", sql="""
    SELECT event_id, station_id, time, parameter, value, 'City' || (event_id % 4) AS city FROM obs_long""")
def multi_location_union(obs_long):
    path = landing_path(obs_long, "cities")
    rows = obs_long.select(
        "event_id", "station_id", "time", "parameter", "value",
        F.concat(F.lit("City"), (F.col("event_id") % 4).cast("string")).alias("city"),
    )
    sources.write_table(rows, path, partition_by=["city"])
    return sources.read_table(obs_long.sparkSession, path, rows.schema)


@part.query("weather", sql="""
    SELECT time, lat, lon, temperature, humidity, wind_speed, boundary_layer_height FROM weather""")
def project_available(weather):
    order = ["time", "lat", "lon", "temperature", "pressure", "humidity", "wind_speed", "boundary_layer_height"]
    return sources.project_available(weather, order)


CATEGORY_SQL = """CASE WHEN {0} <= 12 THEN '🟢 GOOD' WHEN {0} <= 35 THEN '🟡 MODERATE'
    WHEN {0} <= 55 THEN '🟠 UNHEALTHY FOR SENSITIVE GROUPS' WHEN {0} <= 150 THEN '🔴 UNHEALTHY'
    ELSE '🟣 HAZARDOUS' END"""
INDEX_SQL = """CAST(trunc(CASE WHEN {0} <= 12 THEN {0} / 12 * 50 WHEN {0} <= 35 THEN 50 + ({0} - 12) / 23 * 50
    WHEN {0} <= 55 THEN 100 + ({0} - 35) / 20 * 50 WHEN {0} <= 150 THEN 150 + ({0} - 55) / 95 * 50
    ELSE 500 END) AS INTEGER)"""


@part.query("scored", sql=f"""
    SELECT event_id, time AS timestamp, station_id AS location, p AS pm25, {INDEX_SQL.format('p')} AS aqi,
           {CATEGORY_SQL.format('p')} AS category, CAST(time AS DATE) AS date
    FROM scored""")
def prediction_log(scored):
    path = landing_path(scored, "log")
    rows = scored.select(
        "event_id",
        F.col("time").alias("timestamp"),
        F.col("station_id").alias("location"),
        F.col("p").alias("pm25"),
        aqi_index(F.col("p")).alias("aqi"),
        aqi_category(F.col("p")).alias("category"),
    )
    for half in (0, 1):
        sources.append_log(rows.where(F.col("event_id") % 2 == half), path)
    return scored.sparkSession.read.schema(rows.schema.add("date", "date")).parquet(path)


def _report_sql(source: str, ranges: dict[str, tuple[str, float | None, float | None]]) -> str:
    parts = []
    for rule, (column, low, high) in ranges.items():
        tests = [f"{column} < {low}" if low is not None else "", f"{column} > {high}" if high is not None else ""]
        condition = " OR ".join(t for t in tests if t)
        parts.append(f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {condition}) AS violations FROM raw")
    return f", raw AS ({source}) " + " UNION ALL ".join(parts)


@part.query("stations", sql=_report_sql(
    "SELECT lat * 4 AS lat, lon * 25 / 1e1 - 30 AS lon FROM stations",
    {"lat_range": ("lat", -90, 90), "lon_range": ("lon", -180, 180)},
))
def validate_geo(stations):
    raw = stations.select((F.col("lat") * 4).alias("lat"), (F.col("lon") * 25 / 10 - 30).alias("lon"))
    return sources.violation_report(raw, sources.STATION_RULES)


RAW_AEROSOL_SQL = """SELECT l_orderkey, l_linenumber, time, lat * 4 AS lat, lon,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE round(aod * 8 - 1, 6) END AS aod,
    round(cloud_fraction * 15 / 1e1, 6) AS cloud_fraction FROM aerosol"""


def _raw_aerosol(aerosol):
    return aerosol.select(
        "l_orderkey", "l_linenumber", "time", (F.col("lat") * 4).alias("lat"), "lon",
        F.when(F.col("l_linenumber") != 3, F.round(F.col("aod") * 8 - 1, 6)).alias("aod"),
        F.round(F.col("cloud_fraction") * 15 / 10, 6).alias("cloud_fraction"),
    )


@part.query("aerosol", sql=_report_sql(RAW_AEROSOL_SQL, {
    "lat_range": ("lat", -90, 90), "lon_range": ("lon", -180, 180),
    "aod_range": ("aod", 0, 5), "cloud_fraction_range": ("cloud_fraction", 0, 1),
}))
def validate_aerosol(aerosol):
    return sources.violation_report(_raw_aerosol(aerosol), sources.AEROSOL_RULES)


@part.query("weather", sql=_report_sql(
    """SELECT temperature + o_orderkey % 40 AS temperature, humidity * 12 / 1e1 - 5 AS humidity,
              wind_speed - 3 AS wind_speed, boundary_layer_height * 2 AS boundary_layer_height FROM weather""",
    {
        "temperature_range": ("temperature", 200, 330), "humidity_range": ("humidity", 0, 100),
        "wind_speed_range": ("wind_speed", 0, None), "boundary_layer_height_range": ("boundary_layer_height", 0, 3000),
    },
))
def validate_weather(weather):
    raw = weather.select(
        (F.col("temperature") + F.col("o_orderkey") % 40).alias("temperature"),
        (F.col("humidity") * 12 / 10 - 5).alias("humidity"),
        (F.col("wind_speed") - 3).alias("wind_speed"),
        (F.col("boundary_layer_height") * 2).alias("boundary_layer_height"),
    )
    return sources.violation_report(raw, sources.WEATHER_RULES)


@part.query("aerosol", sql=f"""
    , raw AS ({RAW_AEROSOL_SQL})
    SELECT l_orderkey, l_linenumber, time, lat, lon, aod, cloud_fraction, concat_ws(',',
        CASE WHEN lat < -90 OR lat > 90 THEN 'lat_range' END, CASE WHEN lon < -180 OR lon > 180 THEN 'lon_range' END,
        CASE WHEN aod < 0 OR aod > 5 THEN 'aod_range' END,
        CASE WHEN cloud_fraction < 0 OR cloud_fraction > 1 THEN 'cloud_fraction_range' END) AS broken_rules
    FROM raw""")
def quarantine(aerosol):
    marked = sources.quarantine(_raw_aerosol(aerosol), sources.AEROSOL_RULES)
    return marked.withColumn("broken_rules", F.concat_ws(",", "broken_rules"))


@part.query("events", sql="""
    SELECT event_id, date_trunc('second', ts) AS time, value FROM events
    WHERE event_id % 10 <> 0 AND event_id % 15 <> 1""")
def safe_parse(events):
    number = F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.col("value").cast("string"))
    moment = F.when(F.col("event_id") % 15 == 1, "2024-13-45").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    parsed = events.select("event_id", parse_time(moment).alias("time"), parse_number(number).alias("value"))
    return parsed.where("time is not null and value is not null")


@part.query("features", sql="SELECT event_id, pm25 FROM features WHERE pm25 <= 100 OR pm25 IS NULL")
def outlier_filter(features):
    return drop_outliers(features, "pm25", 100).select("event_id", "pm25")


@part.query("obs_long", sql="""
    SELECT event_id, station_id AS location_name, value AS pm25, time AS observed_at FROM obs_long""")
def rename_project(obs_long):
    return obs_long.select(
        "event_id",
        F.col("station_id").alias("location_name"),
        F.col("value").alias("pm25"),
        F.col("time").alias("observed_at"),
    )


@part.query("obs_long", sql="""
    SELECT event_id, lower(parameter) AS parameter, value FROM obs_long WHERE lower(parameter) LIKE '%pm%'""")
def param_filter(obs_long):
    lowered = F.lower("parameter")
    return obs_long.where(lowered.contains("pm")).select("event_id", lowered.alias("parameter"), "value")


@part.query("stations", sql="""
    SELECT station_key, 'Nation' || nation_key || '-' || CASE WHEN station_key % 3 = 0 THEN CAST(station_key AS VARCHAR)
        ELSE station_id END AS full_name FROM stations""", name="station_key")
def full_station_name(stations):
    city = F.concat(F.lit("Nation"), F.col("nation_key").cast("string"))
    name = F.when(F.col("station_key") % 3 != 0, F.col("station_id"))
    return stations.select("station_key", station_key(city, name, F.col("station_key")).alias("full_name"))


@part.query("events", sql="""
    SELECT event_id, CASE WHEN event_id % 12 = 0 THEN NULL
        WHEN event_id % 5 = 0 THEN date_trunc('second', ts) - INTERVAL '330' MINUTE
        ELSE date_trunc('second', ts) END AS time
    FROM events""")
def ts_parse(events):
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_id") % 12 == 0, "not a date")
        .when(F.col("event_id") % 5 == 0, F.concat(local, F.lit("+05:30")))
        .otherwise(F.concat(local, F.lit("Z")))
    )
    return events.select("event_id", parse_time(text).alias("time"))


@part.query("obs", sql="""
    SELECT event_id, pm25, CAST(NULL AS DOUBLE) AS aod, CAST(NULL AS DOUBLE) AS humidity FROM obs""")
def pad_missing(obs):
    return sources.pad_missing(obs.select("event_id", "pm25"), ["pm25", "aod", "humidity"])


QUERIES, ORACLES = part.queries, part.oracles
