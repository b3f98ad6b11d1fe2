from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerofuse.operators import asof, spatial
from aerofuse.operators.asof import asof_join, choose_layout, densest_slice
from aerofuse.operators.reshape import latest_measurements, merge_pm10, pivot_measurements
from aerofuse.operators.update import match_update, places_in_largest_cell
from aerofuse.params import FusionParams
from aerofuse.plans.fusion import fuse, fuse_period
from aerofuse.sources.rules import ValidationError

START = datetime(2024, 1, 1)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def series(seed, n, keys, hours=200, step=1):
    """Random (key, time) rows; about a third belong to one key and instants repeat."""
    rng = random.Random(seed)
    return [
        (i, "hot" if rng.random() < 0.34 else rng.choice(keys), START + timedelta(minutes=step * rng.randrange(hours * 60 // step)))
        for i in range(n)
    ]


def expected_asof(left, right, minutes, direction, exact):
    out = {}
    for i, key, t in left:
        candidates = [
            (abs((rt - t).total_seconds()), rt, j)
            for j, rkey, rt in right
            if rkey == key and abs((rt - t).total_seconds()) <= minutes * 60 and (exact or rt != t)
            and (direction != "backward" or rt <= t) and (direction != "forward" or rt >= t)
        ]
        out[i] = min(candidates)[2] if candidates else None
    return out


@pytest.mark.parametrize("layout", ["slices", "ranges", "auto"])
@pytest.mark.parametrize("direction,exact", [
    ("nearest", True), ("backward", True), ("forward", True), ("backward", False), ("forward", False),
])
def test_asof_equals_brute_force(spark, many_shards, layout, direction, exact):
    left, right = series(1, 250, "abc", step=7), series(2, 200, "abd", step=7)
    l = frame(spark, left, "id long, k string, time timestamp_ntz")
    r = frame(spark, right, "j long, k string, time timestamp_ntz")
    got = asof_join(l, r, values=("j",), by=("k",), order=("j",), tolerance=timedelta(minutes=90),
                    direction=direction, exact=exact, layout=layout)
    assert {x["id"]: x["j"] for x in got.collect()} == expected_asof(left, right, 90, direction, exact)


def test_asof_matches_pandas_without_a_key(spark, many_shards):
    left = [(i, t) for i, _, t in series(3, 300, "ab")]
    right = [(i, t) for i, _, t in series(4, 100, "ab")]
    got = asof_join(
        frame(spark, left, "id long, time timestamp_ntz"), frame(spark, right, "j long, time timestamp_ntz"),
        values=("j",), order=("j",), tolerance=timedelta(hours=1),
    )
    lp = pd.DataFrame(left, columns=["id", "time"]).sort_values("time")
    rp = pd.DataFrame(right, columns=["j", "time"]).sort_values(["time", "j"]).drop_duplicates("time")
    want = pd.merge_asof(lp, rp, on="time", direction="nearest", tolerance=pd.Timedelta(hours=1))
    assert {r["id"]: r["j"] for r in got.collect()} == {
        int(i): None if pd.isna(j) else int(j) for i, j in zip(want["id"], want["j"])
    }


@pytest.mark.parametrize("layout", ["slices", "ranges"])
def test_asof_tolerance_is_inclusive_and_ties_go_back(spark, layout):
    hour = timedelta(hours=1)
    left = [(1, START), (2, START + 10 * hour), (3, START + 20 * hour), (4, None)]
    right = [("at_limit", START - 6 * hour), ("before", START + 8 * hour), ("after", START + 12 * hour),
             ("too_far", START + 26 * hour + timedelta(microseconds=1))]
    got = asof_join(
        frame(spark, left, "id long, time timestamp_ntz"), frame(spark, right, "v string, time timestamp_ntz"),
        values=("v",), tolerance=6 * hour, layout=layout, gap="gap",
    )
    rows = {r["id"]: (r["v"], r["gap"]) for r in got.collect()}
    assert rows[1] == ("at_limit", -6 * 3_600_000_000)
    assert rows[2][0] == "before" and rows[3][0] is None and rows[4][0] is None


def test_asof_keeps_every_copy_of_a_busy_instant(spark):
    left = spark.range(5000).select("id", F.lit(START).cast("timestamp_ntz").alias("time"), F.lit("hot").alias("k"))
    right = spark.range(5000).select(
        F.lit(START).cast("timestamp_ntz").alias("time"), F.lit("hot").alias("k"), (F.col("id") + 5).alias("v")
    )
    got = asof_join(left, right, values=("v",), by=("k",), tolerance=timedelta(hours=1))
    assert [tuple(r) for r in got.groupBy("v").count().collect()] == [(5, 5000)]


def test_asof_refuses_unknown_options(spark):
    df = frame(spark, [(1, START)], "v long, time timestamp_ntz")
    with pytest.raises(ValueError, match="direction"):
        asof_join(df, df, values=("v",), tolerance=timedelta(1), direction="sideways")
    with pytest.raises(ValueError, match="layout"):
        asof_join(df, df, values=("v",), tolerance=timedelta(1), layout="heap")
    assert densest_slice(df, [], timedelta(hours=1)) == 1


def brute_nearest(left, right, radius):
    out = {}
    b = np.radians(np.array(right))
    for lat, lon in left:
        a = np.radians([lat, lon])
        h = np.sin((b[:, 0] - a[0]) / 2) ** 2 + np.cos(a[0]) * np.cos(b[:, 0]) * np.sin((b[:, 1] - a[1]) / 2) ** 2
        d = 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(1, h)))
        best = min((round(float(x), 6), *p) for x, p in zip(d, right))
        if best[0] <= radius:
            out[(lat, lon)] = best[1:]
    return out


@pytest.mark.parametrize("levels", [None, 0, 2])
@pytest.mark.parametrize("region,radius", [
    ((8, 35, 68, 97), 50.0), ((8, 35, 68, 97), 300.0), ((84, 90, -180, 180), 120.0), ((-5, 5, 176, 184), 80.0),
])
def test_nearest_equals_brute_force(spark, levels, region, radius):
    rng = random.Random(str((region, radius)))

    def point(digits):
        lon = round(rng.uniform(region[2], region[3]), digits)
        return round(rng.uniform(region[0], region[1]), digits), lon if lon <= 180 else round(lon - 360, digits)

    left, right = [point(3) for _ in range(60)], [point(1) for _ in range(500)]
    right += [left[0], (90.0, 0.0)]
    got = spatial.nearest_within(
        frame(spark, left + left[:10] + [(None, 1.0)], "lat double, lon double"),
        frame(spark, right * 2, "lat double, lon double"), radius, levels=levels,
    )
    assert {(r["lat"], r["lon"]): (r["near_lat"], r["near_lon"]) for r in got.collect()} == brute_nearest(
        left, right, radius
    )


def test_crowded_cells_are_cut_before_places_are_compared(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CROWD", 20)
    rng = random.Random(5)
    # A third of all places share a few kilometres, and searching places lie inside and around them.
    right = [(round(20 + rng.gauss(0, 0.01), 6), round(75 + rng.gauss(0, 0.01), 6)) for _ in range(400)]
    right += [(round(rng.uniform(15, 25), 3), round(rng.uniform(70, 80), 3)) for _ in range(800)]
    left = [(round(20 + rng.gauss(0, 0.3), 4), round(75 + rng.gauss(0, 0.3), 4)) for _ in range(80)]
    targets = spatial._with_position(frame(spark, right, "lat double, lon double"))
    assert spatial._levels_needed(targets, 2 * spatial._chord_km(60.0)) >= 2
    got = spatial.nearest_within(
        frame(spark, left, "lat double, lon double"), frame(spark, right, "lat double, lon double"), 60.0
    )
    assert {(r["lat"], r["lon"]): (r["near_lat"], r["near_lon"]) for r in got.collect()} == brute_nearest(
        left, right, 60.0
    )


def grids(spark, days=3):
    """Three stations, a 1-degree aerosol grid and a 2-degree weather grid, daily."""
    names = [("Delhi", 28.61, 77.25), ("Mumbai", 18.93, 72.84), ("Nowhere", 60.5, 10.5)]
    times = [START + timedelta(days=d) for d in range(days)]
    stations = frame(
        spark, [(t, la, lo, 50.0 + d, 80.0, s) for s, la, lo in names for d, t in enumerate(times)],
        "time timestamp_ntz, lat double, lon double, pm25 double, pm10 double, station_id string",
    )
    air = [(t, float(a), float(o), 0.01 * a, 0.5) for t in times for a in range(8, 36) for o in range(68, 98)]
    met = [(t, float(a), float(o), 290.0, 40.0, 3.0, 800.0) for t in times for a in range(8, 36, 2) for o in range(68, 98, 2)]
    return (
        stations,
        frame(spark, air, "time timestamp_ntz, lat double, lon double, aod double, cloud_fraction double"),
        frame(spark, met, "time timestamp_ntz, lat double, lon double, temperature double, humidity double, "
                          "wind_speed double, boundary_layer_height double"),
    )


WIDE = FusionParams(aerosol_radius_km=80.0, weather_radius_km=160.0)


def test_fusion_has_the_documented_columns_and_drops_far_stations(spark):
    fused = fuse(*grids(spark), WIDE, unique_grids=True)
    assert set(fused.columns) == {
        "time", "lat", "lon", "station_id", "pm25", "pm10", "aod", "cloud_fraction", "temperature", "humidity",
        "wind_speed", "boundary_layer_height",
    }
    rows = fused.collect()
    assert {r["station_id"] for r in rows} == {"Delhi", "Mumbai"} and len(rows) == 6
    assert {round(r["aod"], 2) for r in rows if r["station_id"] == "Delhi"} == {0.29}


def test_fusion_by_period_and_station(spark):
    got = fuse_period(*grids(spark), START, START + timedelta(days=1), ["Mumbai"], WIDE)
    assert [r["station_id"] for r in got.collect()] == ["Mumbai", "Mumbai"]


def test_layout_follows_the_distinct_instants_of_a_slice(spark):
    hour = timedelta(hours=1)
    copies = frame(spark, [("k", START)] * 9 + [("k", START + hour / 2), ("j", START), ("j", None)], "k string, time timestamp_ntz")
    few = copies.where("k = 'j'")
    assert choose_layout(copies, few, ["k"], hour) == "slices"
    assert choose_layout(copies, few, ["k"], hour, limit=2) == "slices"  # nine copies, two instants
    assert choose_layout(few, copies, ["k"], hour, limit=1) == "ranges"
    assert choose_layout(few.where("false"), few.where("false"), ["k"], hour, limit=0) == "slices"


def test_fusion_is_the_same_over_ranges(spark, many_shards, monkeypatch):
    sources = grids(spark)
    untimed = sources[0].withColumn("time", F.when(F.col("station_id") != "Mumbai", F.col("time")))
    for stations in (sources[0], sources[0].unionByName(sources[0]), untimed):
        want = sorted(map(str, fuse(stations, *sources[1:], WIDE, layout="slices").collect()))
        monkeypatch.setattr(asof, "MAX_SLICE_ROWS", 0)
        assert sorted(map(str, fuse(stations, *sources[1:], WIDE).collect())) == want
        monkeypatch.undo()


def test_invalid_rows_stop_warn_or_are_set_aside(spark, tmp_path):
    stations, air, met = grids(spark)
    bad = air.withColumn("aod", F.when(F.col("time") == START, F.lit(9.0)).otherwise(F.col("aod")))
    period = (START - timedelta(days=1), START + timedelta(days=9))
    broken = air.where(F.col("time") == START).count()
    assert broken
    with pytest.raises(ValidationError, match=f"aod_range: {broken} rows"):
        fuse_period(stations, bad, met, *period, params=WIDE)
    with pytest.warns(UserWarning, match=f"aerosol: .* aod_range {broken}"):
        reported = fuse_period(stations, bad, met, *period, params=WIDE, on_invalid="report")
    assert reported.count() == fuse(stations, air, met, WIDE).count()
    kept = fuse_period(stations, bad, met, *period, params=WIDE, on_invalid="split", rejected=str(tmp_path))
    want = fuse(stations, air.where(F.col("time") != START), met, WIDE)
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
    aside = spark.read.parquet(str(tmp_path / "aerosol")).collect()
    assert [r["broken_rules"] for r in aside] == [["aod_range"]] * broken
    with pytest.raises(ValueError, match="on_invalid"):
        fuse_period(stations, air, met, *period, on_invalid="hope")
    with pytest.raises(ValueError, match="folder"):
        fuse_period(stations, air, met, *period, on_invalid="split")


def test_smaller_radius_never_gives_more_rows(spark):
    sources = grids(spark)
    sizes = [
        fuse(*sources, FusionParams(aerosol_radius_km=r, weather_radius_km=160.0)).count() for r in (5.0, 50.0, 80.0)
    ]
    assert sizes == sorted(sizes)


def test_empty_source_is_refused_on_request(spark):
    stations, air, met = grids(spark)
    with pytest.raises(ValidationError, match="station data is empty"):
        fuse_period(stations.where("false"), air, met, START, START, fail_on_empty=True)
    with pytest.raises(ValidationError, match="in the radius"):
        fuse_period(stations, air, met, START, START, ["Nowhere"], WIDE, fail_on_empty=True)
    assert fuse(stations.where("false"), air, met, WIDE).count() == 0


def test_pivot_does_not_depend_on_arrival_order(spark):
    rows = [(1, "s", "pm10", 80.0), (2, "s", "pm25", 40.0), (3, "s", "pm25", 41.0), (4, "s", "no2", 9.0), (5, "t", "pm10", 7.0)]
    long = frame(spark, rows, "seq long, station_id string, parameter string, value double")
    got = {r["station_id"]: (r["pm25"], r["pm10"]) for r in pivot_measurements(long, ["station_id"], "seq").collect()}
    assert got == {"s": (41.0, 80.0), "t": (None, 7.0)}


def test_coarse_reading_is_estimated_only_without_any(spark):
    rows = [(START, 1.0, 2.0, "pm25", 10.0), (START, 1.0, 3.0, "pm25", 20.0), (START, 1.0, 2.0, "pm10", 33.0)]
    long = frame(spark, rows, "time timestamp_ntz, lat double, lon double, parameter string, value double")
    assert sorted((r["pm25"], r["pm10"]) for r in merge_pm10(long).collect() if r["pm10"]) == [(10.0, 33.0)]
    only_fine = merge_pm10(long.where("parameter = 'pm25'"))
    assert sorted((r["pm25"], r["pm10"]) for r in only_fine.collect()) == [(10.0, 15.0), (20.0, 30.0)]


@pytest.mark.parametrize("route", ["places", "moments", "auto"])
def test_match_update_equals_row_by_row(spark, route):
    rng = random.Random(9)

    def place():
        return round(20 + rng.randrange(40) * 0.013, 4), round(75 + rng.randrange(40) * 0.013, 4)

    targets = [(i, START + timedelta(minutes=30 * rng.randrange(100)), *place(), 1.0, 2.0) for i in range(300)]
    observed = [
        (i, START + timedelta(minutes=10 * rng.randrange(300)), *place(), 100.0 + i, None if i % 3 else 500.0 + i)
        for i in range(400)
    ]
    want = {t[0]: [t[4], t[5]] for t in targets}
    ordered = sorted(targets, key=lambda t: (t[1], t[0]))
    for _, time, lat, lon, pm25, pm10 in observed:
        first = next((t for t in ordered if abs(t[1] - time) < timedelta(hours=1) and abs(t[2] - lat) < 0.1
                      and abs(t[3] - lon) < 0.1), None)
        if first:
            want[first[0]][0] = pm25
            want[first[0]][1] = pm10 if pm10 is not None else want[first[0]][1]
    got = match_update(
        frame(spark, targets, "tid long, time timestamp_ntz, lat double, lon double, pm25 double, pm10 double"),
        frame(spark, observed, "oid long, time timestamp_ntz, lat double, lon double, pm25 double, pm10 double"),
        target_key="tid", observation_order=("oid",), route=route,
    )
    assert {r["tid"]: [r["pm25"], r["pm10"]] for r in got.collect()} == want
    assert sum(v[0] != 1.0 for v in want.values()) > 20


@pytest.mark.parametrize("coarse", [True, False])
def test_latest_measurements_update_like_all_of_them(spark, coarse):
    rng = random.Random(4)
    names = ["pm25", "pm10", "no2"] if coarse else ["pm25", "no2"]
    long = frame(spark, [
        (i, START + timedelta(minutes=30 * rng.randrange(6)), 20.0, 75.0 + rng.randrange(3), rng.choice(names),
         float(i) if rng.random() < 0.8 else None)
        for i in range(200)
    ], "oid long, time timestamp_ntz, lat double, lon double, parameter string, value double")
    targets = frame(spark, [
        (i, START + timedelta(minutes=25 * i), 20.0, 75.0 + i % 3, 1.0, 2.0) for i in range(12)
    ], "tid long, time timestamp_ntz, lat double, lon double, pm25 double, pm10 double")
    options = dict(target_key="tid", observation_order=("oid", "pm10_oid"))
    reduced, whole = latest_measurements(long, "oid"), merge_pm10(long, key="oid")
    assert reduced.count() == whole.select("time", "lat", "lon").distinct().count() < whole.count()
    got, want = (sorted(map(tuple, match_update(targets, w, **options).collect())) for w in (reduced, whole))
    assert got == want and any(row[4] != 1.0 for row in got)


def test_moving_instruments_are_recognised(spark):
    def trail(n, spread):
        return spark.range(n).select((20.01 + F.col("id") % spread * 1e-6).alias("lat"), F.lit(75.0).alias("lon"))

    assert places_in_largest_cell(trail(3000, 3000), 0.1) == 3000
    # One crowded cell decides, however many others there are.
    others = spark.range(500).select((F.col("id") * 0.1 - 50).alias("lat"), F.lit(10.0).alias("lon"))
    assert places_in_largest_cell(trail(3000, 3000).unionByName(others), 0.1) == 3000
    assert places_in_largest_cell(trail(3000, 3), 0.1) == 3
    assert places_in_largest_cell(trail(0, 1), 0.1) == 0


def test_skeleton_covers_both_ends_and_gaps_are_what_is_missing(spark):
    skeleton = spatial.grid_skeleton(
        spark, start=START, end=START + timedelta(days=2), lat_min=8.0, lat_max=9.0, lon_min=68.0, lon_max=68.5,
        step=0.1, digits=1,
    )
    rows = [tuple(r) for r in skeleton.collect()]
    assert len(rows) == len(set(rows)) == 3 * 11 * 6
    assert max(rows) == (START + timedelta(days=2), 9.0, 68.5)
    seen = skeleton.where("lat < 8.95").select("time", "lat", "lon")
    assert spatial.coverage_gaps(skeleton, seen.unionByName(seen)).count() == 3 * 6


def test_unknown_names_get_the_default_or_stay_unknown(spark):
    names = frame(spark, [("Delhi",), ("Pune",)], "station_id string")
    table = frame(spark, [("Delhi", 28.61, 77.25)], "station_id string, lat double, lon double")
    assert {tuple(r) for r in spatial.place_of(names, table, "station_id", 20.0, 75.0).collect()} == {
        ("Delhi", 28.61, 77.25), ("Pune", 20.0, 75.0),
    }
    assert ("Pune", None, None) in {tuple(r) for r in spatial.place_of(names, table, "station_id").collect()}
