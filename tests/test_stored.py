from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aerofuse.streaming.committed import WIDTH
from aerofuse.streaming.ingest import read_arrivals
from aerofuse.streaming.stored import StoredSummary

SCHEMA = "station_id string, lat double, lon double, time timestamp_ntz, pm25 double"
START = datetime(2024, 1, 1)
BY_STATION = StoredSummary(["station_id"], ["pm25"])
WHOLE = StoredSummary((), ["pm25"], {"stations": ["station_id"], "cells": ["lat", "lon"]})


def some(spark, first, n, stations):
    return spark.createDataFrame(
        [(f"s{k % stations}", float(k % 7), float(k % 5), START + timedelta(hours=k), float(k % 90)) for k in range(first, first + n)], SCHEMA)


def test_merged_parts_equal_one_scan(spark, tmp_path):
    path, rows = str(tmp_path / "parts"), some(spark, 0, 3000, 40)
    for k in range(3):
        assert BY_STATION.add(rows.where(F.pmod(F.hash("time"), F.lit(3)) == k), path, "load", k)
    assert not BY_STATION.add(rows, path, "load", 1)  # a batch that is tried again
    got = BY_STATION.merged(BY_STATION.read(spark, path, rows.schema))
    want = rows.groupBy("station_id").agg(
        F.count("*").alias("rows"), F.min("time").alias("start"), F.max("time").alias("end"), F.count("pm25").alias("pm25_n"),
        F.avg("pm25").alias("pm25_mean"), F.min("pm25").alias("pm25_min"), F.max("pm25").alias("pm25_max"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_summary_after_an_append_opens_only_parts(spark, tmp_path):
    path = str(tmp_path / "parts")
    first, second = some(spark, 0, 500, 30), some(spark, 500, 100, 60)
    WHOLE.add(first, path, "load", 0)
    before = len(WHOLE.read(spark, path, first.schema).inputFiles())
    WHOLE.add(second, path, "load", 1)
    parts = WHOLE.read(spark, path, first.schema)
    files = parts.inputFiles()
    assert len(files) > before and all("/parts/data/" in f for f in files)
    row = WHOLE.merged(parts).first()
    assert (row["rows"], row["stations"], row["cells"], row["end"]) == (600, 60, 35, START + timedelta(hours=599))


def test_many_batches_are_merged_and_add_up(spark, tmp_path):
    path, n = str(tmp_path / "parts"), WIDTH + 2
    for k in range(n):
        WHOLE.add(some(spark, 50 * k, 50, 10), path, "load", k)
    parts = WHOLE.read(spark, path, some(spark, 0, 1, 1).schema)
    assert WHOLE.merged(parts).first()["rows"] == 50 * n
    assert len({f.rsplit("/", 2)[1] for f in parts.inputFiles()}) == 3


def test_error_of_the_distinct_count(spark, tmp_path):
    for n in (1, 100, 5_000, 200_000):
        rows = spark.range(n).select(
            F.col("id").cast("string").alias("station_id"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"),
            F.lit(START).cast("timestamp_ntz").alias("time"), F.lit(1.0).alias("pm25"))
        whole = WHOLE.merged(WHOLE.parts(rows.union(rows))).first()
        assert abs(whole["stations"] - n) <= 0.05 * n and whole["cells"] == 1 and whole["rows"] == 2 * n


def test_nulls_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, 1.0, None, None, None), (None, 1.0, 2.0, START, float("nan")), ("a", 1.0, 2.0, START, 3.0), ("a", 1.0, 2.0, START, 3.0)], SCHEMA)
    whole = WHOLE.merged(WHOLE.parts(rows)).first()
    assert (whole["rows"], whole["stations"], whole["cells"], whole["pm25_n"], whole["pm25_mean"]) == (4, 1, 1, 2, 3.0)
    assert {r["day"] is None for r in WHOLE.parts(rows).collect()} == {True, False}
    each = {r["station_id"]: (r["rows"], r["pm25_n"], r["pm25_mean"]) for r in BY_STATION.merged(BY_STATION.parts(rows)).collect()}
    assert each == {None: (2, 0, None), "a": (2, 2, 3.0)}
    none = WHOLE.merged(WHOLE.read(spark, str(tmp_path / "none"), rows.schema)).first()
    assert (none["rows"], none["stations"], none["cells"], none["pm25_n"], none["pm25_mean"], none["start"]) == (0, 0, 0, 0, None, None)


def test_stream_adds_new_files_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "parts")

    def refresh(state="state"):
        arrivals = read_arrivals(spark, f"{folder}/*", SCHEMA)
        WHOLE.add_stream(arrivals, path, str(tmp_path / state)).awaitTermination()
        return WHOLE.merged(WHOLE.read(spark, path, arrivals.schema)).first()["rows"]

    some(spark, 0, 20, 4).write.parquet(f"{folder}/a")
    assert refresh() == 20 and refresh() == 20
    some(spark, 20, 5, 4).write.parquet(f"{folder}/b")
    assert refresh() == 25
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        refresh("other")
