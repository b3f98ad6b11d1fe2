from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aerofuse import sources
from aerofuse.params import FEATURES, ForestParams, FusionParams, QualityParams, TrainingParams
from aerofuse.sources import schemas
from aerofuse.sources.rules import require_rows, split_sound


def test_missing_columns_are_named_in_order(spark):
    df = spark.createDataFrame([(0.1, 10)], "aod double, pm25 int")
    with pytest.raises(sources.ValidationError, match="temperature, humidity, wind_speed"):
        sources.require_columns(df, FEATURES)
    with pytest.raises(sources.ValidationError, match="The table lacks"):
        sources.check_schema(df, schemas.STATION.names, ["lat"])


def test_types_are_checked_without_a_job(spark):
    df = spark.sql("SELECT 'x' AS lat, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS time, 1 AS pm25")
    with pytest.raises(sources.ValidationError, match="holds string, a number is needed"):
        sources.check_schema(df, ["lat"], ["lat"])
    with pytest.raises(sources.ValidationError, match="holds no timestamps"):
        sources.check_schema(df.withColumn("time", F.lit("2024")), ["time"])
    assert sources.check_schema(df, ["time", "pm25"], ["pm25"]) is df


def test_rules_are_inclusive_and_pass_missing_values(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (5.0, 1.0), (5.1, 1.0), (None, None), (-0.1, 1.2)], "aod double, cloud_fraction double"
    ).withColumns({"lat": F.lit(90.0), "lon": F.lit(-180.0)})
    report = {r["rule"]: r["violations"] for r in sources.violation_report(df, sources.AEROSOL_RULES).collect()}
    assert report == {"lat_range": 0, "lon_range": 0, "aod_range": 2, "cloud_fraction_range": 1}
    sound, aside = split_sound(df, sources.AEROSOL_RULES)
    assert (sound.count(), aside.count()) == (3, 2)
    assert sorted(map(tuple, (r["broken_rules"] for r in aside.collect()))) == [
        ("aod_range",), ("aod_range", "cloud_fraction_range"),
    ]
    with pytest.raises(sources.ValidationError, match="aod_range: 2 rows, cloud_fraction_range: 1 rows"):
        sources.enforce(df, sources.AEROSOL_RULES)
    assert sources.enforce(sound, sources.AEROSOL_RULES) is sound


def test_weather_rules_leave_the_place_alone(spark):
    df = spark.sql("SELECT 500D lat, 200D temperature, 100D humidity, 0D wind_speed, 3000D boundary_layer_height")
    sources.enforce(df, sources.WEATHER_RULES)
    with pytest.raises(sources.ValidationError):
        sources.enforce(df.withColumn("wind_speed", F.lit(-0.1)), sources.WEATHER_RULES)


def test_empty_input_can_be_refused(spark):
    with pytest.raises(sources.ValidationError, match="is empty"):
        require_rows(spark.createDataFrame([], schemas.STATION), "The station data is empty")


def test_first_existing_path_wins(spark, tmp_path):
    (tmp_path / "b").mkdir()
    assert sources.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]) == str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        sources.first_existing(spark, [str(tmp_path / "a")])


def test_scans_keep_both_ends(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2024-01-30', TIMESTAMP_NTZ '2024-03-02', INTERVAL 1 DAY)) time")
    assert sources.between_dates(df, datetime(2024, 2, 1), datetime(2024, 2, 3)).count() == 3
    assert sources.in_months(df, date(2024, 2, 20), date(2024, 2, 21)).count() == 29
    assert sources.in_months(df, date(2023, 12, 5), date(2024, 1, 1)).count() == 2
    assert sources.in_months(df, date(2025, 1, 1), date(2025, 12, 1)).count() == 0


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-30 00:00:00' time, 1 v, 2 unused").write.parquet(path)
    kept = sources.between_dates(spark.read.parquet(path), datetime(2024, 1, 1), datetime(2024, 2, 1)).select("v")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan and "unused" not in plan


def test_station_choice_by_list_and_table(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "station_id string")
    assert sources.only_stations(df, None) is df
    assert {r[0] for r in sources.only_stations(df, ["a", "z"]).collect()} == {"a"}
    assert {r[0] for r in sources.only_stations(df, [f"s{i}" for i in range(2000)] + ["b"]).collect()} == {"b"}
    assert {r[0] for r in sources.only_stations(df, df.where("station_id = 'c'")).collect()} == {"c"}


def test_box_is_inclusive(spark):
    df = spark.createDataFrame([(10.0, 70.0), (20.0, 80.0), (20.1, 75.0)], "lat double, lon double")
    assert sources.in_box(df, lat_min=10, lat_max=20, lon_min=70, lon_max=80).count() == 2


def test_nested_documents_flatten_and_skip_bad_rows(spark, tmp_path):
    location = {"id": 7, "coordinates": {"latitude": 28.6, "longitude": 77.2}}
    results = [
        {"parameter": "PM25", "value": 41.5, "date": {"utc": "2024-01-01T00:00:00Z"}},
        {"parameter": "pm10", "value": "80", "date": {"utc": "2024-01-01T00:00:00Z"}},
        {"parameter": "pm10", "value": "n/a", "date": {"utc": "2024-01-01T00:00:00Z"}},
        {"parameter": "pm25", "value": 3, "date": {"utc": "yesterday"}},
        {"parameter": "pm25", "value": 3},
        {"parameter": "no2", "value": 3, "date": {"utc": "2024-01-01T00:00:00Z"}},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"city": "Delhi", "location": location, "results": results}))
    flat = sources.flatten_landing(sources.read_table(spark, str(tmp_path), schemas.LANDING, "json"))
    rows = flat.orderBy("results_position").collect()
    assert [(r["station_id"], r["parameter"], r["value"]) for r in rows] == [
        ("Delhi-7", "pm25", 41.5), ("Delhi-7", "pm10", 80.0),
    ]


def test_both_measurement_layouts_are_read(spark):
    wide = spark.sql("SELECT 's' station_id, 1D lat, 2D lon, TIMESTAMP_NTZ '2024-01-01' time, 5D pm25, CAST(NULL AS DOUBLE) pm10")
    assert [(r["parameter"], r["value"]) for r in sources.unify_layout(wide).collect()] == [("pm25", 5.0)]
    long = spark.sql(
        "SELECT 's' location_name, 1D latitude, 2D longitude, '2024-01-01T00:00:00Z' datetimeUtc, 'pm25' parameter, 5D value"
    )
    assert sources.unify_layout(long).columns == ["station_id", "lat", "lon", "time", "parameter", "value"]


def test_csv_round_trip_makes_folders_and_projects(spark, tmp_path):
    df = spark.sql("SELECT 1.5D value, 's' station_id, 'x' extra")
    path = str(tmp_path / "deep" / "er")
    sources.write_table(df, path, "csv", columns=["station_id", "absent", "value"])
    assert [tuple(r) for r in spark.read.csv(path, header=True).collect()] == [("s", "1.5")]


def test_csv_columns_are_typed_by_name_and_extra_ones_kept(spark, tmp_path):
    path = str(tmp_path / "u")
    spark.sql("SELECT 'x' note, 1.5D aod, 40 pm25, TIMESTAMP_NTZ '2024-01-01 00:00:00' time").write.csv(path, header=True)
    df = sources.read_unified(spark, path, required=["aod", "pm25"])
    assert df.schema.simpleString() == "struct<note:string,aod:double,pm25:double,time:timestamp_ntz>"
    assert df.first()["aod"] == 1.5


def test_read_unified_reports_missing_columns(spark, tmp_path):
    path = str(tmp_path / "u")
    spark.sql("SELECT 1D aod, 2D pm25").write.parquet(path)
    with pytest.raises(sources.ValidationError, match="The table lacks temperature"):
        sources.read_unified(spark, path, "parquet", schema=None)


def test_union_and_padding(spark):
    a, b = spark.sql("SELECT 1 x"), spark.sql("SELECT 2 x, 3 y")
    assert sorted(map(tuple, sources.union_all([a, b]).collect()), key=str) == [(1, None), (2, 3)]
    padded = sources.pad_missing(a, ["x", "aod"])
    assert padded.schema.simpleString() == "struct<x:int,aod:double>"


def test_log_appends_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' timestamp, 1D pm25")
    sources.append_log(rows, path)
    sources.append_log(rows, path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.select("date").distinct().count() == 1


@pytest.mark.parametrize("make", [
    lambda: TrainingParams(test_size=0), lambda: TrainingParams(test_size=1), lambda: TrainingParams(features=()),
    lambda: QualityParams(max_missing_fraction=1), lambda: QualityParams(on_exceed="ignore"),
    lambda: FusionParams(aerosol_radius_km=0),
])
def test_parameters_are_checked(make):
    with pytest.raises(ValueError):
        make()


def test_parameter_defaults():
    params = TrainingParams()
    assert (params.seed, params.target, params.test_size) == (42, "pm25", 0.2)
    assert (params.forest, len(params.features)) == (ForestParams(300, 16, 2), 8)
