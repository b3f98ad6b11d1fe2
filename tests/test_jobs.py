from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from aerofuse.__main__ import main
from aerofuse.params import FEATURES, ForestParams, FusionParams, TrainingParams
from aerofuse.plans import training
from aerofuse.plans.fusion import fuse
from aerofuse.session import size_shuffles
from aerofuse.sources import ValidationError, load_metrics
from aerofuse.sources.schemas import FUSED_COLUMNS, TRAINING_COLUMNS
from test_joins import START, grids


def test_fuse_job_writes_the_documented_columns(spark, tmp_path):
    for name, df in zip(("stations", "aerosol", "weather"), grids(spark)):
        df.write.parquet(str(tmp_path / name))
    main([
        "fuse", *(x for n in ("stations", "aerosol", "weather", "output") for x in (f"--{n}", str(tmp_path / n))),
        "--start", "2024-01-01", "--end", "2024-01-02", "--station", "Delhi", "--aerosol-radius-km", "80",
        "--weather-radius-km", "160",
    ])
    got = spark.read.parquet(str(tmp_path / "output"))
    assert got.columns == list(FUSED_COLUMNS) and got.count() == 2

    # The fused table can be scored as it is: the day of the year follows from the time.
    rng = random.Random(3)
    known = spark.createDataFrame(
        [tuple(rng.uniform(0, 1) for _ in (*FEATURES, "pm25")) for _ in range(40)],
        ", ".join(f"{c} double" for c in (*FEATURES, "pm25")),
    )
    model = training.train_forest(known, TrainingParams(forest=ForestParams(trees=2, max_depth=2)))
    model.write().save(str(tmp_path / "model"))
    main(["score", "--model", str(tmp_path / "model"), "--input", str(tmp_path / "output"), "--output", str(tmp_path / "scored")])
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.count() == 2 and "predicted_pm25" in scored.columns


@pytest.mark.parametrize("layout", ["wide", "long"])
def test_load_job_puts_measured_values_in_place(spark, tmp_path, layout):
    frames = grids(spark)
    for name, df in zip(("stations", "aerosol", "weather"), frames):
        df.write.parquet(str(tmp_path / name))
    place = frames[0].where("station_id = 'Delhi'").orderBy("time").first()
    reading = spark.createDataFrame(
        [("m", place["lat"] + 0.01, place["lon"], place["time"] + timedelta(minutes=10), 123.0)],
        "station_id string, lat double, lon double, time timestamp_ntz, pm25 double",
    )
    if layout == "long":
        reading = reading.selectExpr(
            "'m' AS location_id", "station_id AS location_name", "'pm25' AS parameter", "pm25 AS value", "'x' AS unit",
            "date_format(time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS datetimeUtc", "lat AS latitude", "lon AS longitude",
        )
    reading.write.parquet(str(tmp_path / "measurements"))
    main([
        "load", *(x for n in ("stations", "aerosol", "weather", "measurements", "output") for x in (f"--{n}", str(tmp_path / n))),
        "--aerosol-radius-km", "80", "--on-invalid", "split", "--rejected", str(tmp_path / "rejected"),
    ])
    got = spark.read.parquet(str(tmp_path / "output"))
    assert got.columns == list(TRAINING_COLUMNS)
    assert got.count() == fuse(*frames, FusionParams(aerosol_radius_km=80.0, weather_radius_km=150.0)).count()
    hits = got.where("pm25 = 123.0").collect()
    assert [(r["station_id"], r["time"], r["pm10"]) for r in hits] == [("Delhi", place["time"], 184.5)]
    assert spark.read.parquet(str(tmp_path / "rejected" / "weather")).count() == 0


def test_train_then_score(spark, tmp_path):
    rng = random.Random(2)
    rows = [
        (i, START + timedelta(hours=i), *(rng.uniform(0, 1) if i % 8 else None for _ in FEATURES[:-1]), float(i % 50))
        for i in range(120)
    ]
    schema = "id long, time timestamp_ntz, " + ", ".join(f"{c} double" for c in (*FEATURES[:-1], "pm25"))
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "table"))
    main([
        "train", "--input", str(tmp_path / "absent"), "--input", str(tmp_path / "table"), "--key", "id",
        "--output", str(tmp_path / "out"), "--trees", "3", "--max-depth", "3",
    ])
    assert load_metrics(spark, str(tmp_path / "out" / "metrics")).first()["rmse"] > 0

    ready = spark.read.parquet(str(tmp_path / "table")).withColumn("day_of_year", F.dayofyear("time"))
    ready.write.parquet(str(tmp_path / "new"))
    ready.coalesce(1).write.csv(str(tmp_path / "new_csv"), header=True)
    main([
        "--format", "csv", "score", "--model", str(tmp_path / "out" / "model"), "--input", str(tmp_path / "new_csv"),
        "--output", str(tmp_path / "scored_csv"),
    ])
    assert spark.read.csv(str(tmp_path / "scored_csv"), header=True).where("predicted_pm25 is null").count() == 15
    main(["score", "--model", str(tmp_path / "out" / "model"), "--input", str(tmp_path / "new"), "--output", str(tmp_path / "scored")])
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 120

    model = training.load_model(str(tmp_path / "out" / "model"))
    request = {f: [0.5, 0.7] for f in FEATURES}
    answers = training.score(model, training.feature_frame(spark, request)).orderBy("row").collect()
    assert [r["row"] for r in answers] == [0, 1] and all(r["prediction"] is not None for r in answers)
    with pytest.raises(ValidationError, match="lacks aod"):
        training.feature_frame(spark, {f: [1.0] for f in FEATURES[1:]})


def test_shuffles_are_sized_by_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 << 40) == 819_200
        assert size_shuffles(spark, 1) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_load_job_does_not_depend_on_files(spark, tmp_path):
    frames = grids(spark)
    place = frames[0].where("station_id = 'Delhi'").orderBy("time").first()
    # Several readings for one target, two of them at the same instant, one of them twice.
    readings = spark.createDataFrame(
        [(f"m{k % 3}", place["lat"] + 0.01, place["lon"], place["time"] + timedelta(minutes=k // 2), 100.0 + 7 * (k * 5 % 11)) for k in range(12)] * 2,
        "station_id string, lat double, lon double, time timestamp_ntz, pm25 double",
    )
    found = []
    for files, by in ((1, F.col("pm25")), (5, F.col("pm25").desc())):
        folder = tmp_path / str(files)
        for name, df in zip(("stations", "aerosol", "weather", "measurements"), (*frames, readings)):
            df.repartition(files).sortWithinPartitions(by if "pm25" in df.columns else df.columns[0]).write.parquet(str(folder / name))
        main(["load", *(x for n in ("stations", "aerosol", "weather", "measurements", "output") for x in (f"--{n}", str(folder / n)))])
        found.append(sorted(map(str, spark.read.parquet(str(folder / "output")).collect())))
    assert found[0] == found[1]
    last = max((r["time"], r["station_id"], r["pm25"]) for r in readings.collect())
    assert any(f"pm25={last[2]}" in row for row in found[0])
