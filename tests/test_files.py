from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse import sources
from aerofuse.operators import ordering
from aerofuse.sources import places

PLACES = "k long, lat double, lon double"


def test_box_ranges_hold_every_place_of_the_box(spark):
    draw = random.Random(1)
    points = [(k, draw.uniform(-90, 90), draw.uniform(-180, 180)) for k in range(3000)] + [(-1, 90.0, 180.0), (-2, -90.0, -180.0), (-3, 0.0, 0.0)]
    keyed = spark.createDataFrame(points, PLACES).select("*", places.place_key(F.col("lat"), F.col("lon")).alias("key")).collect()
    for _ in range(40):
        south, west = draw.uniform(-95, 85), draw.uniform(-185, 170)
        box = dict(lat_min=south, lat_max=south + draw.choice([0, 1, 20, 200]), lon_min=west, lon_max=west + draw.choice([0, 2, 30, 400]))
        ranges = sources.box_ranges(**box)
        assert len(ranges) <= places.MAX_RANGES and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        for r in keyed:
            if box["lat_min"] <= r["lat"] <= box["lat_max"] and box["lon_min"] <= r["lon"] <= box["lon_max"]:
                assert any(low <= r["key"] <= high for low, high in ranges)


def test_a_box_reads_a_small_part_of_the_files(spark, tmp_path):
    draw = random.Random(2)
    rows = [(k, draw.uniform(8, 36), draw.uniform(68, 98)) for k in range(8000)] + [(k, 20.0, 75.0) for k in range(8000, 12000)]
    rows += [(-1, None, 70.0), (-2, float("nan"), 70.0)]
    df = spark.createDataFrame(rows, PLACES)
    sources.write_by_place(df, str(tmp_path), 200)
    box = dict(lat_min=10.0, lat_max=13.0, lon_min=70.0, lon_max=73.0)
    files = spark.read.parquet(f"{tmp_path}/index").count()
    assert files >= 50 and len(sources.files_of_box(spark, str(tmp_path), **box)) <= files // 8
    got = sources.read_box(spark, str(tmp_path), df.schema, **box)
    assert sorted(r["k"] for r in got.collect()) == sorted(k for k, a, b in rows if a is not None and 10 <= a <= 13 and 70 <= b <= 73)
    assert "PushedFilters" in got._jdf.queryExecution().toString() and "place_key" in got._jdf.queryExecution().toString()
    # A crowded place is spread over several files.
    assert spark.read.parquet(f"{tmp_path}/index").agg(F.max("rows")).first()[0] <= 600
    assert sources.read_box(spark, str(tmp_path), df.schema, lat_min=-50.0, lat_max=-49.0, lon_min=0.0, lon_max=1.0).count() == 0


def test_unreadable_files_cost_only_themselves(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, x string")
    for name, n in (("a", 50), ("b", 30), ("empty", 0)):
        spark.range(n).selectExpr("id AS k", "repeat(md5(string(id)), 20) AS x").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    broken = next((tmp_path / "b").glob("*.parquet"))
    whole = broken.read_bytes()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "page.parquet").write_text("<html>")
    (tmp_path / "c" / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "c" / "nothing.parquet").write_bytes(b"")
    (tmp_path / "c" / "damaged.parquet").write_bytes(whole[:40] + bytes(len(whole) - 440) + whole[-400:])
    rows, errors = sources.read_readable(spark, str(tmp_path), schema)
    assert rows.count() == 80 and rows.agg(F.sum("k")).first()[0] == sum(range(50)) + sum(range(30))
    found = {r["file"].rsplit("/", 1)[1]: r for r in errors.collect()}
    assert {"page.parquet", "cut.parquet", "damaged.parquet"} <= set(found) <= {"page.parquet", "cut.parquet", "damaged.parquet", "nothing.parquet"}
    assert all(r["reason"] for r in found.values()) and found["page.parquet"]["bytes"] == 6
    (tmp_path / "none").mkdir()
    rows, errors = sources.read_readable(spark, str(tmp_path / "none"), schema)
    assert rows.count() == errors.count() == 0


def test_broken_csv_records_are_set_aside(spark, tmp_path):
    schema = T.StructType.fromDDL("station string, time timestamp_ntz, value double")
    lines = ["station,time,value", "a,2024-01-01T00:00:00,1.5", "b,yesterday,2", "c,2024-01-02T00:00:00", "d,2024-01-02T00:00:00,x,9",
             "e,,", '"f,g",2024-01-03T00:00:00,3', '"h,i",2024-01-03T00:00:00,n/a', "j,never,none"]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    sound, broken = sources.read_records(spark, str(tmp_path), schema)
    assert sorted(r["station"] for r in sound.collect()) == ["a", "e", "f,g"]
    found = {r["record"]: r["reason"] for r in broken.collect()}
    assert found == {lines[2]: "type of time", lines[3]: "2 fields, not 3", lines[4]: "4 fields, not 3", lines[7]: "type of value", lines[8]: "type of time, value"}
    assert {r["file"].rsplit("/", 1)[1] for r in broken.collect()} == {"one.csv"}
    assert sound.count() == 3 and broken.count() == 5 and sound.select("value").count() == 3


def test_broken_json_records_are_set_aside(spark, tmp_path):
    schema = T.StructType.fromDDL("city string, value double, results array<struct<parameter:string>>")
    lines = ['{"city":"a","value":1}', '{"city":"b","value":"much"}', '{"city":"c"', '{"value":null,"results":[{"parameter":"pm25"}]}', "<html>",
             '{"city":"d","value":2,"results":7}']
    (tmp_path / "one.json").write_text("\n".join(lines) + "\n")
    sound, broken = sources.read_records(spark, str(tmp_path), schema, "json")
    assert sorted(str(r["city"]) for r in sound.collect()) == ["None", "a"]
    found = {r["record"]: r["reason"] for r in broken.collect()}
    assert found == {lines[1]: "type of value", lines[2]: "no JSON object", lines[4]: "no JSON object", lines[5]: "type of results"}
    with pytest.raises(ValueError):
        sources.read_records(spark, str(tmp_path), schema, "xml")


@pytest.mark.parametrize("sketch", [
    ordering._middle_sketch, lambda c: F.array(F.max(c) + 1, F.max(c) + 2), lambda c: F.array(F.min(c), F.max(c)),
    lambda c: F.array(F.min(c), F.min(c)), lambda c: F.array(F.min(c) - 2, F.min(c) - 1),
])
@pytest.mark.parametrize("few", [3, 10_000])
def test_medians_are_exact_whatever_the_sketch_says(spark, sketch, few):
    draw = random.Random(few)
    inf = float("inf")
    columns = {
        "a": [draw.uniform(-5, 5) for _ in range(2001)], "b": [float(draw.randint(0, 3)) for _ in range(2000)], "c": [7.0] * 500,
        "d": [inf, -inf, 1.0, 2.0, float("nan")], "e": [], "f": [inf] * 5 + [1.0], "g": [3.0],
    }
    rows = [tuple(v[k] if k < len(v) else None for v in columns.values()) for k in range(2001)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = ordering.exact_medians(df, list(columns), sketch, few)
    for c, values in columns.items():
        known = sorted(v for v in values if v == v)
        n = len(known)
        assert got[c] == (None if not n else (known[(n - 1) // 2] + known[n // 2]) / 2), c


def test_small_files_by_place_do_not_mean_as_many_tasks(spark, tmp_path):
    df = spark.range(12_000).selectExpr("id AS k", "double(id % 83) AS lat", "double(id % 97) AS lon")
    sources.write_by_place(df, str(tmp_path), 100)
    index = spark.read.parquet(f"{tmp_path}/index").collect()
    assert len(index) >= 120 and max(r["rows"] for r in index) <= 100 and sum(r["rows"] for r in index) == 12_000
    assert len({r["file"][:10] for r in index}) <= spark.sparkContext.defaultParallelism
