from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from aerofuse.streaming import committed, ingest

SCHEMA = "station_id string, parameter string, time timestamp_ntz, value double"
START = datetime(2024, 1, 1)


def arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def rows_at(hours, value=1.0, station="s"):
    return [(station, "pm25", START + timedelta(hours=h), value) for h in hours]


def refresh(spark, folder, out, files=1000, state="state"):
    stream = ingest.read_arrivals(spark, f"{folder}/*", SCHEMA, files_per_batch=files)
    ingest.add_new(stream, f"{out}/rows", f"{out}/{state}", "value").awaitTermination()
    return ingest.measurements(spark, f"{out}/rows", stream.schema)


def test_overlapping_refresh_adds_each_measurement_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, "week1", rows_at(range(10)) + rows_at(range(3), 2.0))
    assert refresh(spark, folder, out).count() == 10
    # The next run reads only the new file; what overlaps with the first is dropped.
    arrive(spark, folder, "week2", rows_at(range(5, 15), 3.0))
    got = refresh(spark, folder, out).collect()
    assert len(got) == 15 and sorted(r["value"] for r in got) == [1.0] * 10 + [3.0] * 5


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_late_files_lose_nothing(spark, tmp_path, files):
    folder = str(tmp_path / "in")
    for k, first_day in enumerate((210, 150, 30, 0)):  # the newest arrives first
        arrive(spark, folder, f"f{k}", rows_at(range(24 * first_day, 24 * (first_day + 10), 24), float(k)) + rows_at([24 * first_day], float(k)))
    assert refresh(spark, folder, str(tmp_path / "out"), files).count() == 40
    stream = ingest.read_arrivals(spark, f"{folder}/*", SCHEMA, files_per_batch=files)
    ingest.add_daily_sums(stream, f"{tmp_path}/sums", f"{tmp_path}/sums-state", "value").awaitTermination()
    means = ingest.daily_means(ingest.daily_sums(spark, f"{tmp_path}/sums")).collect()
    assert len(means) == 40 and sum(r["n"] for r in means) == 44


def test_batch_twin_keeps_the_first_and_skips_the_known(spark):
    df = spark.createDataFrame(
        [(2, "s", "pm25", START, 2.0), (1, "s", "pm25", START, 1.0), (3, "t", "pm25", START, 3.0)],
        "seq long, station_id string, parameter string, time timestamp_ntz, value double",
    )
    assert {(r["station_id"], r["value"]) for r in ingest.first_of_batch(df, "seq").collect()} == {("s", 1.0), ("t", 3.0)}
    left = ingest.first_of_batch(df, "seq", known=df.where("station_id = 's'")).collect()
    assert [r["station_id"] for r in left] == ["t"]


def test_a_second_checkpoint_adds_nothing_twice_and_loses_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, "week1", rows_at(range(10)))
    assert refresh(spark, folder, out).count() == 10
    arrive(spark, folder, "week2", rows_at(range(5, 15), 3.0))
    # The new checkpoint reads both files, as batch 0 like the first one's.
    got = refresh(spark, folder, out, state="other").collect()
    assert len(got) == 15 and sorted(r["value"] for r in got) == [1.0] * 10 + [3.0] * 5
    assert refresh(spark, folder, out).count() == 15  # the first one goes on, and finds the second file written


def test_null_keys_are_added_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    odd = [("s", "pm25", None, 1.0), (None, "pm25", START, 1.0), (None, None, None, 1.0)]
    for k in range(3):
        arrive(spark, folder, f"f{k}", odd + rows_at([k]))
        assert refresh(spark, folder, out, files=1).count() == 4 + k


def test_a_batch_that_failed_after_writing_adds_nothing_twice(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, "f", rows_at(range(5)))
    whole = committed.CommittedTable._commit

    def fail(self, commit):
        raise OSError("lost")

    monkeypatch.setattr(committed.CommittedTable, "_commit", fail)
    with pytest.raises(StreamingQueryException):
        refresh(spark, folder, out)
    monkeypatch.setattr(committed.CommittedTable, "_commit", whole)
    assert refresh(spark, folder, out).count() == 5
    table = committed.CommittedTable(spark, f"{out}/rows")
    assert table.remove_unused() == 1 and len(table.live()) == 1


def test_folders_stay_few(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, date date")
    table = committed.CommittedTable(spark, str(tmp_path), ["date"])
    for k in range(20):
        assert table.add(spark.range(1).selectExpr(f"{k}L AS k", "CAST(NULL AS DATE) AS date"), "one", k)
        assert not table.add(spark.range(9).selectExpr("id AS k", "CAST(NULL AS DATE) AS date"), "one", k)
    assert len(table.live()) == 2 + 4 and sorted(r["k"] for r in table.read(schema).collect()) == list(range(20))
    assert table.remove_unused() == 16 and table.read(schema).count() == 20
    late = committed.Commit(3, "two", 0, "data/x", 0)
    with pytest.raises(committed.ConflictError):
        table._commit(late)


def test_daily_sums_belong_to_one_checkpoint(spark, tmp_path):
    folder = str(tmp_path / "in")
    arrive(spark, folder, "f", rows_at(range(5)))

    def run(state):
        stream = ingest.read_arrivals(spark, f"{folder}/*", SCHEMA)
        ingest.add_daily_sums(stream, f"{tmp_path}/sums", f"{tmp_path}/{state}", "value").awaitTermination()

    run("a")
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        run("b")
    assert [r["n"] for r in ingest.daily_sums(spark, f"{tmp_path}/sums").collect()] == [5]
