from __future__ import annotations

import random
from datetime import datetime, timedelta
from math import ceil

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerofuse import session
from aerofuse.operators import ordering
from aerofuse.operators.interpolate import impute, interpolate_linear
from aerofuse.operators.split import mark_test, split
from aerofuse.params import TrainingParams

START = datetime(2024, 1, 1)


def gappy(seed=1, n=600):
    """Series of several stations with long gaps; one station holds about half of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = "hot" if rng.random() < 0.5 else rng.choice("abcd")
        known = rng.random() < 0.08 and station != "d"
        rows.append((
            i, station, START + timedelta(hours=rng.randrange(50)),
            round(rng.uniform(0, 100), 3) if known else None, float(i) if i % 7 == 0 else None,
        ))
    return rows


SCHEMA = "id long, station string, time timestamp_ntz, x double, y double"


@pytest.mark.parametrize("limit", [0, 500_000])
def test_ranges_are_cut_by_rows_and_joined_with_or_without_broadcast(spark, many_shards, monkeypatch, limit):
    monkeypatch.setattr(ordering, "SHARD_ROWS", 20)
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    rows = gappy()
    df = spark.createDataFrame(rows, SCHEMA)
    laid = ordering.range_shards(df, ["station", "time", "id"])
    assert ordering.count_shards(laid) > 13
    assert laid.groupBy(ordering.SHARD).count().agg(F.max("count")).first()[0] < 120
    got = {r["id"]: (r["x"], r["y"]) for r in interpolate_linear(df, ["x", "y"], order_by=("time", "id")).collect()}
    want = pandas_interpolated(rows, False)
    assert all(got[i] == pytest.approx(want[i], rel=1e-12) for i in want)
    numbers = ordering.with_position(df, ["time", "id"]).select("id", "position").collect()
    assert [r["id"] for r in sorted(numbers, key=lambda r: r["position"])] == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]


def pandas_interpolated(rows, keyed):
    pdf = pd.DataFrame(rows, columns=["id", "station", "time", "x", "y"]).sort_values(["time", "id"])
    for c in ("x", "y"):
        fill = lambda s: s.astype(float).interpolate(limit_direction="both")
        pdf[c] = pdf.groupby("station")[c].transform(fill) if keyed else fill(pdf[c])
    return {int(i): (x, y) for i, x, y in zip(pdf["id"], pdf["x"], pdf["y"])}


@pytest.mark.parametrize("keyed", [True, False])
def test_interpolation_equals_pandas_across_shards(spark, many_shards, keyed):
    rows = gappy()
    df = spark.createDataFrame(rows, SCHEMA)
    by = ("station",) if keyed else ()
    order = ("time", "id")
    shards = ordering.range_shards(df, [*by, *order]).select(ordering.SHARD).distinct().count()
    assert shards > 5
    got = interpolate_linear(df, ["x", "y"], order_by=order, partition_by=by)
    want = pandas_interpolated(rows, keyed)
    for r in got.collect():
        for mine, theirs in zip((r["x"], r["y"]), want[r["id"]]):
            assert (mine is None and np.isnan(theirs)) or mine == pytest.approx(theirs, rel=1e-12)
    assert got.columns == df.columns and got.count() == len(rows)


def test_interpolation_does_not_depend_on_the_layout(spark, many_shards):
    df = spark.createDataFrame(gappy(3, 200), SCHEMA)
    results = []
    for parts in (1, 4, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = interpolate_linear(df.repartition(parts), ["x"], order_by=("time", "id"), partition_by=("station",))
        results.append({r["id"]: r["x"] for r in got.collect()})
    assert results[0] == results[1] == results[2]


def test_impute_fills_unknown_series_with_the_median(spark):
    rows = [(1, "a", START, 1.0), (2, "a", START + timedelta(1), None), (3, "a", START + timedelta(2), 4.0), (4, "b", START, None)]
    df = spark.createDataFrame(rows, "id long, station string, time timestamp_ntz, x double")
    got = impute(df, ["x"], order_by=("time", "id"), partition_by=("station",))
    assert {r["id"]: r["x"] for r in got.collect()} == {1: 1.0, 2: 2.5, 3: 4.0, 4: 2.5}
    assert impute(df.withColumn("x", F.lit(None).cast("double")), ["x"], order_by=("id",)).where("x is null").count() == 4


def test_impute_leaves_complete_columns_alone(spark):
    df = spark.range(5).select("id", F.col("id").cast("int").alias("whole"))
    got = impute(df, ["whole"], order_by=("id",))
    assert got.schema["whole"].dataType.simpleString() == "double" and got.count() == 5
    assert impute(df.where("false"), ["whole"], order_by=("id",)).count() == 0


@pytest.mark.parametrize("keyed", [True, False])
def test_positions_equal_pandas(spark, many_shards, keyed):
    rows = gappy(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = ordering.with_position(df, ("time", "id"), ("station",) if keyed else ())
    pdf = pd.DataFrame(rows, columns=["id", "station", "time", "x", "y"]).sort_values(["time", "id"])
    want = pdf.groupby("station").cumcount() + 1 if keyed else pd.Series(range(1, len(pdf) + 1), index=pdf.index)
    assert {r["id"]: r["position"] for r in got.collect()} == dict(zip(pdf["id"], want))


@pytest.mark.parametrize("few", [0, 50])
@pytest.mark.parametrize("name", ["uniform", "copies", "spread", "negative", "one"])
def test_values_at_ranks_equal_a_sort(spark, name, few):
    rng = np.random.default_rng(7)
    data = {
        "uniform": rng.uniform(0, 1, 3000),
        "copies": np.r_[np.full(1000, 5.0), rng.integers(0, 10, 2000).astype(float)],
        "spread": np.exp(rng.uniform(-200, 200, 1500)),
        "negative": rng.normal(0, 1e6, 1001),
        "one": np.array([3.25]),
    }[name]
    df = spark.createDataFrame([(float(v), int(v) if abs(v) < 1e12 else 0) for v in data] + [(None, None)], "x double, n long")
    for column, values in (("x", data), ("n", [int(v) if abs(v) < 1e12 else 0 for v in data])):
        ranks = sorted({0, len(data) // 3, len(data) // 2, len(data) - 1})
        got = ordering.values_at_ranks(df, [(column, r) for r in ranks], few)
        assert got == [sorted(values)[r] for r in ranks]


def test_medians_equal_those_of_numpy(spark, monkeypatch):
    rng = random.Random(3)
    inf = float("inf")
    columns = {
        "a": [rng.gauss(0, 1) for _ in range(1000)],
        "b": [float(rng.randrange(5)) if i % 3 else None for i in range(1000)],
        "c": [None] * 1000,
        "d": [inf if i % 3 == 0 else -inf if i % 7 == 0 else rng.random() for i in range(1000)],
        "e": [float("nan") if i % 2 else 1.7e308 * rng.uniform(-1, 1) for i in range(1000)],
        "f": [inf if i % 5 else 1.0 for i in range(1000)],
        "g": [3.5] + [None] * 999,
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    for few in (10_000, 0):
        monkeypatch.setattr(ordering.values_at_ranks, "__defaults__", (few,))
        got = ordering.exact_medians(df, list(columns))
        assert got.pop("c") is None
        for c, value in got.items():
            known = [v for v in columns[c] if v is not None and v == v]
            assert value == pytest.approx(float(np.median(known)), rel=1e-15)


@pytest.mark.parametrize("few", [0, 10_000])
def test_cut_falls_inside_a_group_of_equal_values(spark, few):
    rows = [(1, i) for i in range(400)] + [(0, i) for i in range(100)] + [(2, i) for i in range(100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "t long, id long")
    for rank in (0, 99, 100, 333, 599):
        assert ordering.cut_at_rank(df, ["t", "id"], rank, few) == list(sorted(rows)[rank])


@pytest.mark.parametrize("n", [1, 5, 20, 101])
@pytest.mark.parametrize("shuffle", [True, False])
def test_split_sizes_are_exact_and_repeatable(spark, n, shuffle):
    df = spark.range(n).select("id", (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 7).cast("int"))).alias("time"))
    params = TrainingParams(shuffle=shuffle)
    train, test = split(df, params, ["id"])
    assert (train.count(), test.count()) == (n - ceil(n * 0.2), ceil(n * 0.2))
    again = split(df.repartition(3), params, ["id"])[1]
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}
    if not shuffle and train.count():
        assert train.agg(F.max("time")).first()[0] <= test.agg(F.min("time")).first()[0]


def test_twenty_rows_split_sixteen_to_four_and_the_seed_matters(spark):
    df = spark.range(20)
    picks = [
        {r["id"] for r in mark_test(df, TrainingParams(seed=s), ["id"]).where("is_test").collect()} for s in (42, 43)
    ]
    assert len(picks[0]) == len(picks[1]) == 4 and picks[0] != picks[1]


def test_rows_without_a_time_stay_in_the_ordered_split(spark):
    df = spark.createDataFrame([(i, None if i < 3 else START + timedelta(i)) for i in range(10)], "id long, time timestamp_ntz")
    train, test = split(df, TrainingParams(shuffle=False), ["id"])
    assert (train.count(), {r["id"] for r in test.collect()}) == (8, {8, 9})


@pytest.mark.parametrize("few", [3, 10_000])
def test_digests_are_cut_like_the_sorted_list_in_few_passes(spark, few):
    import hashlib

    from aerofuse.operators import split as splitting

    df = spark.range(3000).union(spark.range(3)).selectExpr("nullif(id, 7) AS id")
    digests = sorted(hashlib.md5(("42" if r["id"] is None else f"{r['id']}-42").encode()).hexdigest() for r in df.collect())
    digest = splitting._digest(["id"], 42)
    for rows in (1, 600, 3003):
        assert splitting._cut(df, digest, lambda _: rows, few) == (3003, digests[rows - 1])
    assert splitting._cut(df, digest, lambda _: 0) == splitting._cut(df, digest, lambda _: 4000) == (3003, None)
    fitted = splitting.rows_to_fit(df, TrainingParams(fit_rows=50), ["id"])
    assert sorted(r["d"] for r in fitted.select(digest.alias("d")).collect()) == [d for d in digests if d <= digests[49]]
    spark.sparkContext.setJobGroup(f"cut {few}", "")
    try:
        mark_test(df, TrainingParams(), ["id"])
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cut {few}")) <= 4  # two passes
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ranges_keep_to_their_rows_where_few_bytes_would_be_merged(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SHARD_ROWS", 1500)
    df = spark.range(10_000).selectExpr("id", "id % 3 AS station", "IF(id % 4 = 0, double(id), NULL) AS x")
    laid = ordering.range_shards(df, ["station", "id"])
    assert laid.groupBy(ordering.SHARD).count().agg(F.max("count")).first()[0] <= 3000
    swept = interpolate_linear(df, ["x"], order_by=("id",), partition_by=("station",))
    assert "hashpartitioning(station#" in str(swept._jdf.queryExecution()) and ", 14)" in str(swept._jdf.queryExecution())
    assert swept.where("x IS NULL").count() == 0 and swept.count() == 10_000
