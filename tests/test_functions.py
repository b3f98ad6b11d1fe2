from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from aerofuse import functions
from aerofuse.functions.airquality import advice_table


def values(df):
    return [r[0] for r in df.collect()]


def test_clip_keeps_missing_values(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.5,), (9.0,)], "x double")
    assert values(df.select(functions.clip(F.col("x"), 0.0, 1.0))) == [None, 0.0, 0.5, 1.0]


def test_haversine_known_distances(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 1.0), (90.0, 0.0, -90.0, 0.0), (10.0, 179.5, 10.0, -179.5), (5.0, 5.0, 5.0, 5.0)],
        "a double, b double, c double, d double",
    )
    got = values(df.select(functions.haversine_km(*map(F.col, "abcd"))))
    degree = 6371.0 * math.pi / 180
    assert got[0] == pytest.approx(degree)
    assert got[1] == pytest.approx(180 * degree)
    assert got[2] == pytest.approx(2 * 6371 * math.asin(math.cos(math.radians(10)) * math.sin(math.radians(0.5))))
    assert got[3] == 0.0


def test_bands_and_index_at_their_limits(spark):
    points = [0.0, 12.0, 12.5, 29.63, 35.0, 35.1, 55.0, 55.5, 150.0, 150.5, -3.0, None]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    rows = df.select(functions.aqi_category(F.col("p")), functions.aqi_index(F.col("p"))).collect()
    assert [r[1] for r in rows] == [0, 50, 51, 88, 100, 100, 150, 150, 200, 500, -12, None]
    assert [r[0][2:] if r[0] else None for r in rows] == [
        "GOOD", "GOOD", "MODERATE", "MODERATE", "MODERATE", "UNHEALTHY FOR SENSITIVE GROUPS",
        "UNHEALTHY FOR SENSITIVE GROUPS", "UNHEALTHY", "UNHEALTHY", "HAZARDOUS", "GOOD", None,
    ]
    assert advice_table(spark).count() == 5


def test_index_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-0.9,)], "p double")
    assert values(df.select(functions.aqi_index(F.col("p")))) == [-3]


def test_relative_humidity_by_hand_and_limits(spark):
    df = spark.createDataFrame([(0.005, 288.15), (0.5, 288.15), (-0.1, 288.15), (None, 288.15)], "q double, t double")
    got = values(df.select(functions.relative_humidity(F.col("q"), F.col("t"))))
    saturation = 6.112 * 2.718281828 ** (17.27 * 15 / (237.7 + 15))
    assert got[0] == pytest.approx(0.005 * 1013.25 / 0.622 / saturation * 100)
    assert got[1:] == [100.0, 0.0, None]


def test_wind_speed_and_season(spark):
    df = spark.sql("SELECT 3D u, 4D v, TIMESTAMP_NTZ '2024-07-01 00:00:00' t")
    row = df.select(functions.wind_speed(F.col("u"), F.col("v")), functions.season(F.col("t"))).first()
    assert tuple(row) == (5.0, "monsoon")


def test_parsing_rejects_what_does_not_parse(spark):
    df = spark.createDataFrame(
        [("2024-01-01T05:30:00+05:30", "1.5"), ("2024-01-01T00:00:00Z", "x"), ("nonsense", None)], "t string, v string"
    )
    rows = df.select(functions.parse_time(F.col("t")), functions.parse_number(F.col("v"))).collect()
    assert str(rows[0][0]) == "2024-01-01 00:00:00" and str(rows[1][0]) == "2024-01-01 00:00:00"
    assert rows[2][0] is None
    assert [r[1] for r in rows] == [1.5, None, None]


def test_station_key_falls_back_to_identifier(spark):
    df = spark.createDataFrame([("Delhi", "ITO", 1), ("Delhi", None, 7)], "c string, n string, i long")
    assert values(df.select(functions.station_key(F.col("c"), F.col("n"), F.col("i")))) == ["Delhi-ITO", "Delhi-7"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, n int")
    assert [tuple(r) for r in functions.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_snap_to_grid(spark):
    df = spark.createDataFrame([(8.04,), (8.06,), (34.96,)], "x double")
    assert values(df.select(functions.snap_to_grid(F.col("x"), 8.0, 0.1, 1))) == [8.0, 8.1, 35.0]
