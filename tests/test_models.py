from __future__ import annotations

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerofuse.operators.quality import dropped_rows, missing_fraction, outlier_filter
from aerofuse.operators.summaries import limit_exceedance, regression_metrics
from aerofuse.params import FEATURES, ForestParams, QualityParams, TrainingParams
from aerofuse.plans import training
from aerofuse.plans.forest_table import forest_nodes, score_by_nodes
from aerofuse.plans.preprocess import preprocess
from aerofuse.sources import ValidationError, load_metrics

PARAMS = TrainingParams(forest=ForestParams(trees=5, max_depth=4))


@pytest.fixture(scope="module")
def unified(spark):
    """Two hundred rows whose target follows aod and wind."""
    rng = random.Random(11)
    rows = []
    for i in range(200):
        aod, wind = rng.uniform(0, 2), rng.uniform(0, 10)
        rows.append((
            i, datetime(2024, 1, 1) + timedelta(hours=6 * i), f"s{i % 3}", aod if i % 9 else None,
            rng.uniform(270, 310), rng.uniform(10, 90), wind, rng.uniform(100, 2000), 28.0 + i % 3, 77.0,
            60 * aod - 2 * wind + 40 if i % 20 else None,
        ))
    schema = "id long, time timestamp_ntz, station_id string, " + ", ".join(
        f"{c} double" for c in (*FEATURES[:-1], "pm25")
    )
    return spark.createDataFrame(rows, schema)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 2.1), (3.0, 2.9), (4.0, 3.9)], "y double, prediction double")
    row = regression_metrics(df).first()
    assert tuple(row) == pytest.approx((0.1, 0.1, 0.992))


def test_metrics_on_constant_and_tiny_groups(spark):
    rows = [("exact", 2.0, 2.0), ("exact", 2.0, 2.0), ("off", 2.0, 1.0), ("off", 2.0, 2.0), ("one", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, y double, prediction double")
    assert {r["g"]: r["r2"] for r in regression_metrics(df, by=["g"]).collect()} == {"exact": 1.0, "off": 0.0, "one": None}


def test_metrics_leave_out_rows_without_a_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (100.0, None)], "y double, prediction double")
    assert tuple(regression_metrics(df).first()) == (0.0, 0.0, 1.0)


def test_missing_fraction_and_dropped_rows(spark, unified):
    shares = {r["feature"]: r["missing_fraction"] for r in missing_fraction(unified, ["aod", "humidity"], 0.1).collect()}
    assert shares == pytest.approx({"aod": 23 / 200, "humidity": 0.0})
    assert tuple(dropped_rows(unified, "pm25").first()) == (10, 200)
    assert outlier_filter(unified, "pm25", 0).where("pm25 is null").count() == 10


def test_limits_are_checked_per_day_and_year(spark):
    rows = [("a", datetime(2024, 1, 1, h), 100.0) for h in range(3)] + [("a", datetime(2024, 1, 2), 10.0)]
    df = spark.createDataFrame(rows + [("b", datetime(2024, 1, 1), 60.0)], "station_id string, time timestamp_ntz, pm25 double")
    got = {(r["station_id"], r["period"], r["mean"]) for r in limit_exceedance(df).collect()}
    assert got == {("a", "24h", 100.0), ("a", "annual", 77.5), ("b", "annual", 60.0)}


def test_preprocess_derives_then_checks_then_fills(spark, unified):
    ready = preprocess(unified, PARAMS, order_by=("time", "id"), partition_by=("station_id",), fail_on_empty=True)
    assert ready.count() == 190
    assert ready.where(" or ".join(f"{c} is null" for c in FEATURES)).count() == 0
    assert ready.where("id = 4").first()["day_of_year"] == 2
    with pytest.raises(ValidationError, match="lacks humidity"):
        preprocess(unified.drop("humidity"), PARAMS, order_by=("time",))


def test_preprocess_reports_before_filling(spark, unified):
    empty = unified.withColumn("humidity", F.lit(None).cast("double"))
    options = dict(order_by=("time", "id"), report=True)
    with pytest.raises(ValidationError, match="humidity"):
        preprocess(empty, PARAMS, QualityParams(on_exceed="fail"), **options)
    with pytest.warns(UserWarning, match="humidity"):
        preprocess(empty, PARAMS, QualityParams(), **options)
    with pytest.raises(ValidationError, match="No row is left"):
        preprocess(unified.where("false"), PARAMS, order_by=("time", "id"), fail_on_empty=True)


def test_training_keeps_model_and_metrics(spark, unified, tmp_path):
    ready = preprocess(unified, PARAMS, order_by=("time", "id"), partition_by=("station_id",))
    output = str(tmp_path / "baseline")
    model, metrics = training.train_and_evaluate(ready, ["id"], PARAMS, output)
    [document] = [json.loads(p.read_text()) for p in Path(output, "metrics").glob("part-*.json") if p.read_text()]
    assert set(document) == {"rmse", "mae", "r2"}
    assert load_metrics(spark, f"{output}/metrics").first()["rmse"] == pytest.approx(metrics.first()["rmse"])
    assert document["r2"] > 0.5

    loaded = training.load_model(f"{output}/model")
    ours = {r["id"]: r["prediction"] for r in training.score(model, ready, PARAMS).collect()}
    theirs = {r["id"]: r["prediction"] for r in training.score(loaded, ready, PARAMS).collect()}
    assert ours == theirs and len(ours) == 190

    importances = training.feature_importance(model, PARAMS.features, ready)
    top = training.top_importances(importances, 3).collect()
    assert top[0]["feature"] == "aod" and len(top) == 3
    assert importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)

    path = str(tmp_path / "scores")
    training.score_file(model, ready, path, PARAMS, "csv")
    assert "predicted_pm25" in spark.read.csv(path, header=True).columns

    # A row without a feature keeps its place, without a prediction.
    scored = training.score(model, unified.withColumn("day_of_year", F.dayofyear("time")), PARAMS)
    assert scored.count() == 200 and scored.where("prediction is null").count() == 23
    with pytest.raises(ValidationError, match="lacks day_of_year"):
        training.score(model, unified, PARAMS)


def test_nodes_answer_like_the_model(spark, tmp_path):
    rows = spark.createDataFrame(
        [(k, (k * 37 % 101) / 101, (k * 53 % 97) / 97) for k in range(400)], "k long, a double, b double").selectExpr("*", "10 * a + b AS y")
    params = TrainingParams(features=("a", "b"), target="y", forest=ForestParams(trees=7, max_depth=6))
    model = training.train_forest(rows, params)
    model.write().save(f"{tmp_path}/model")
    scored = training.score(model, rows, params)
    nodes = forest_nodes(spark, f"{tmp_path}/model")
    assert nodes.select("tree").distinct().count() == 7
    both = scored.join(score_by_nodes(rows, nodes, params.features, ["k"]), "k").collect()
    assert len(both) == 400 and all(abs(r["prediction"] - r["by_nodes"]) < 1e-9 for r in both)
    assert len({r["prediction"] for r in both}) > 50


def test_rows_are_not_multiplied_by_the_trees_and_a_large_forest_is_walked_in_blocks(spark, tmp_path, monkeypatch):
    from aerofuse.plans import forest_table

    rows = spark.createDataFrame([(k, (k * 37 % 101) / 101) for k in range(200)], "k long, a double").selectExpr("*", "10 * a AS y")
    params = TrainingParams(features=("a",), target="y", forest=ForestParams(trees=5, max_depth=4))
    model = training.train_forest(rows, params)
    model.write().save(f"{tmp_path}/model")
    nodes = forest_nodes(spark, f"{tmp_path}/model")
    expected = {r["k"]: pytest.approx(r["prediction"], abs=1e-9) for r in training.score(model, rows, params).collect()}
    written, keep = {}, forest_table.materialize
    monkeypatch.setattr(forest_table, "materialize", lambda df, label: written.setdefault(label, keep(df, label)))
    for most in (500_000, 1):  # all trees at once, each alone
        written.clear()
        got = score_by_nodes(rows, nodes, params.features, ["k"], most).collect()
        assert {r["k"]: r["by_nodes"] for r in got} == expected and len(got) == 200
        assert set(written) == {"nodes", "by-nodes"} and written["by-nodes"].count() == 200  # no level is written
