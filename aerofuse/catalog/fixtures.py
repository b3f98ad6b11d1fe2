"""Air-quality shaped views over the driver's tables.

One text serves Spark and DuckDB. ``{events}`` and the like stand for base tables: Spark binds a
DataFrame to them, DuckDB has views of those names. A view may use the views before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerofuse.session import prepare

# Declared, so that no job is run to infer them.
BASE_TABLES = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

VIEWS = {
    "stations": """
        SELECT s_suppkey AS station_key, s_name AS station_id, s_nationkey AS nation_key,
               8 + ((s_suppkey * 371) % 2700) / 1e2 AS lat, 68 + ((s_suppkey * 537) % 2900) / 1e2 AS lon
        FROM {supplier}""",
    "obs_long": """
        SELECT event_id, station_id, lat, lon, value, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
               CASE event_type WHEN 'purchase' THEN 'pm25' WHEN 'click' THEN 'PM25' WHEN 'view' THEN 'pm10'
                               WHEN 'error' THEN 'no2' ELSE 'o3' END AS parameter
        FROM {events} JOIN stations ON station_key = user_id % 10""",
    "obs": """
        SELECT event_id, station_id, lat, lon, time, value AS pm25
        FROM obs_long WHERE parameter = 'pm25'""",
    "aerosol": """
        SELECT CAST(8 + (l_partkey % 28) AS DOUBLE) AS lat,
               CAST(68 + ((l_partkey * 7 + l_suppkey) % 30) AS DOUBLE) AS lon,
               TIMESTAMP '2024-01-01 00:00:00' + (l_orderkey % 30) * INTERVAL '1' DAY
                   + (l_linenumber * 3) * INTERVAL '1' HOUR AS time,
               l_discount * 10 AS aod, l_tax * 10 AS cloud_fraction, l_orderkey, l_linenumber
        FROM {lineitem}""",
    "raw_weather": """
        SELECT 8 + (o_custkey % 22) * 125 / 1e2 AS lat,
               68 + ((o_custkey * 5 + o_orderkey) % 24) * 125 / 1e2 AS lon,
               TIMESTAMP '2024-01-01 00:00:00' + (o_orderkey % 30) * INTERVAL '1' DAY
                   + (o_orderkey % 8 * 3) * INTERVAL '1' HOUR AS time,
               CAST(270 + CAST(floor(o_totalprice) AS BIGINT) % 40 AS DOUBLE) AS temperature,
               (o_orderkey % 20) / 1e3 AS specific_humidity,
               CAST((o_custkey % 13) - 6 AS DOUBLE) AS u_wind, CAST((o_orderkey % 11) - 5 AS DOUBLE) AS v_wind,
               CAST(100 + (o_orderkey % 29) * 100 AS DOUBLE) AS boundary_layer_height, o_orderkey
        FROM {orders}""",
    "weather": """
        SELECT lat, lon, time, temperature,
               round(CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 1e1, 1) AS humidity,
               round(sqrt(u_wind * u_wind + v_wind * v_wind), 6) AS wind_speed, boundary_layer_height, o_orderkey
        FROM raw_weather""",
    # Prepared features with gaps, and rows without the target.
    "features": """
        SELECT event_id, station_id, time, lat, lon,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS pm25,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value / 1e2 + (event_id % 13) / 1e1, 4) END AS aod,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(270 + event_id % 41 AS DOUBLE) END AS temperature,
               CASE WHEN event_id % 9 < 5 THEN NULL ELSE CAST((event_id * 31) % 101 AS DOUBLE) END AS humidity,
               CASE WHEN event_id % 6 = 1 OR station_id LIKE '%3' THEN NULL ELSE ((event_id * 7) % 120) / 1e1 END AS wind_speed,
               CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(100 + (event_id * 13) % 2900 AS DOUBLE) END
                   AS boundary_layer_height
        FROM obs_long""",
    # Wide station rows, some without the coarse reading.
    "station_rows": """
        SELECT event_id, station_id, time, lat, lon, pm25,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(pm25 * 14 / 1e1, 4) END AS pm10
        FROM obs""",
    # Long measurements a little off in place and time, so that only some meet a station row.
    "measured": """
        SELECT event_id, station_id, lat + (day(time) % 5) * 3 / 1e2 AS lat, lon,
               time + (hour(time) % 7) * INTERVAL '12' MINUTE AS time, parameter, value + 1 AS value
        FROM obs_long WHERE parameter IN ('pm25', 'pm10')""",
    # Observed against predicted values.
    "scored": """
        SELECT event_id, station_id, time, value AS y,
               round(value * 9 / 1e1 + (event_id % 17) - 5, 4) AS p
        FROM obs_long""",
}


def spark_view(spark: SparkSession, sf_dir: str, name: str, **replaced: DataFrame) -> DataFrame:
    """A view, or a base table, as a DataFrame; ``replaced`` gives other frames for base tables."""
    prepare(spark)
    if name not in VIEWS:
        return _base(spark, sf_dir, name)
    text = with_views(f"SELECT * FROM {name}", (name,), {t: f"{{{t}}}" for t in BASE_TABLES})
    return spark.sql(text, **{
        t: replaced[t] if t in replaced else _base(spark, sf_dir, t) for t in BASE_TABLES if f"{{{t}}}" in text
    })


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _needed(names: tuple[str, ...]) -> list[str]:
    wanted = set(names)
    for name in reversed(VIEWS):
        if name in wanted:
            wanted.update(v for v in VIEWS if v != name and f" {v} " in f"{VIEWS[name]} ".replace("\n", " "))
    return [v for v in VIEWS if v in wanted]


def with_views(sql: str, names: tuple[str, ...], tables: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the views it needs as common table expressions."""
    tables = tables or {t: t for t in BASE_TABLES}
    clauses = [f"{name} AS ({VIEWS[name].format(**tables)})" for name in _needed(names)]
    return f"WITH {', '.join(clauses)}\n{sql}" if clauses else sql
