"""The forest against brute force and Spark ML, and the rows that the queries fit it on."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from aerofuse.catalog import models
from aerofuse.params import ForestParams, TrainingParams
from aerofuse.plans import forest_fit, training
from aerofuse.sources import ValidationError

PARAMS = TrainingParams(features=("a", "b"), target="y", forest=ForestParams(trees=7, max_depth=6))


@pytest.fixture(scope="module")
def planted(spark):
    return spark.range(400).selectExpr("id AS k", "id * 37 % 101 / 101D AS a", "CAST(id * 53 % 7 AS INT) AS b").selectExpr("*", "10 * a + b AS y")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events and stations of our own; more rows than the forest once was fitted on."""
    folder = str(tmp_path_factory.mktemp("tables"))
    kinds = ("purchase", "click", "view", "error", "other")
    events = [(i, datetime(2024, 1, 1) + timedelta(minutes=17 * i), i * 7 % 40, kinds[i % 5], i * 13 % 97 / 2, None) for i in range(3000)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        f"{folder}/events.parquet")
    spark.createDataFrame([(i, f"s{i}", 1, 0.0) for i in range(10)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(
        f"{folder}/supplier.parquet")
    return folder


@pytest.fixture
def fits(monkeypatch):
    """Rows and nodes of every fit, of a forest small enough for a test."""
    seen, fit = [], training.train_forest

    def small(train, params, *key):
        model = fit(train, replace(params, forest=replace(params.forest, trees=20, max_depth=12)), *key)
        seen.append((train.count(), model.nodes.where("node = 0").agg(F.avg("count")).first()[0]))
        return model

    monkeypatch.setattr(training, "train_forest", small)
    return seen


def test_forest_proof_fits_all_training_rows(spark, tables, fits):
    rows = models.QUERIES["forest_proof"](spark, tables).collect()
    assert len(rows) == 600 and all(r["same_by_nodes"] and r["leader"] == "aod" for r in rows)
    [(train, drawn)] = fits
    assert train == 2400 and abs(drawn - 2400) < 60  # a sample of all rows, with replacement


def test_the_shared_forest_is_fitted_on_all_training_rows(spark, tables, fits):
    rows = models.QUERIES["rf_train"](spark, tables).collect()
    assert sorted(map(tuple, rows)) == [(i, True, True) for i in range(20)]
    [(train, drawn)] = fits
    labelled = sum(1 for i in range(3000) if i % 11)
    assert train == labelled - -(-labelled // 5) and abs(drawn - train) < 60
    assert models.PARAMS.fit_rows is None


def test_grown_splits_are_the_best_there_are():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 9, (300, 3)).astype(np.uint8)
    y = codes[:, 0] * 2.0 - (codes[:, 1] > 4) + rng.normal(size=300)
    w = rng.integers(1, 4, 300).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        tree = forest_fit.grow(codes, y, w, [9, 9, 9], 4, 2)

    def fall(inside, f, last):
        low, high = inside & (codes[:, f] <= last), inside & (codes[:, f] > last)
        if min(w[low].sum(), w[high].sum()) < 2:
            return -np.inf
        spread = lambda rows: (w[rows] * (y[rows] - np.average(y[rows], weights=w[rows])) ** 2).sum()
        return spread(inside) - spread(low) - spread(high)

    def check(node, inside, depth):
        weight = w[inside].sum()
        assert (tree["count"][node], tree["prediction"][node]) == pytest.approx((weight, np.average(y[inside], weights=w[inside])))
        best = max(fall(inside, f, last) for f in range(3) for last in range(8))
        f, last = tree["feature"][node], tree["last"][node]
        if f < 0:
            assert depth == 4 or best < 1e-9 or weight < 4
            return 1
        assert depth < 4 and fall(inside, f, last) == pytest.approx(best) == pytest.approx(tree["gain"][node] * weight)
        low = codes[:, f] <= last
        return 1 + check(tree["below"][node], inside & low, depth + 1) + check(tree["above"][node], inside & ~low, depth + 1)

    assert check(0, np.ones(300, dtype=bool), 0) == len(tree["feature"])


def test_histograms_in_parts_give_the_same_tree(monkeypatch):
    rng = np.random.default_rng(4)
    codes, y = rng.integers(0, 30, (2000, 2)).astype(np.uint8), rng.normal(size=2000)
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = forest_fit.grow(codes, y, np.ones(2000), [30, 30], 16, 2)
        monkeypatch.setattr(forest_fit, "CELLS", 1)
        parts = forest_fit.grow(codes, y, np.ones(2000), [30, 30], 16, 2)
    assert all(np.array_equal(whole[c], parts[c]) for c in whole) and whole["count"].min() >= 2


def test_copies_are_drawn_with_replacement():
    row = np.arange(200_000)
    kept, w = forest_fit.copies(row, 0, 42)
    shares = np.bincount(w.astype(int), minlength=8) / 200_000
    assert len(kept) / 200_000 == pytest.approx(1 - np.exp(-1), abs=0.005)
    assert shares[1:4] == pytest.approx(np.exp(-1) / np.array([1, 2, 6]), abs=0.005)
    assert not np.array_equal(kept, forest_fit.copies(row, 1, 42)[0]) and not np.array_equal(kept, forest_fit.copies(row, 0, 43)[0])
    alone = [forest_fit.copies(np.array([7]), tree, 42) for tree in range(30)]
    assert all(len(kept) == 1 and w[0] >= 1 for kept, w in alone)  # a sample is never empty


def test_borders_tell_few_values_apart_and_cut_many_evenly(spark):
    df = spark.range(40_000).selectExpr("IF(id = 77, 9D, double(id % 3)) AS few", "double(id) AS many", "1D AS one")
    few, many, one = forest_fit.bin_borders(df, ["few", "many", "one"], 16)
    assert few.tolist() == [0.5, 1.5, 5.5] and len(one) == 0  # the one row is seen
    assert len(many) == 15 and many.tolist() == pytest.approx([2500 * i for i in range(1, 16)], abs=20)


def test_spark_ml_reads_the_forest_and_answers_the_same(spark, planted, tmp_path):
    model = training.train_forest(planted, PARAMS)
    path = str(tmp_path / "model")
    model.write().save(path)
    theirs = PipelineModel.load(path)
    expected = {r["k"]: r["prediction"] for r in theirs.transform(planted).collect()}
    for forest in (model, training.load_model(path)):
        assert {r["k"]: r["prediction"] for r in training.score(forest, planted, PARAMS).collect()} == pytest.approx(expected, abs=1e-9)
        assert forest.importances() == pytest.approx(theirs.stages[-1].featureImportances.toArray())
        assert forest.depths() == [(t.depth, t.numNodes) for t in theirs.stages[-1].trees]
    with pytest.raises(Exception, match="already exists"):
        model.write().save(path)
    training.load_model(path).write().overwrite().save(path)  # onto the folder it came from
    assert training.load_model(path).nodes.count() == model.nodes.count()


def test_a_forest_of_spark_ml_can_be_read(spark, planted, tmp_path):
    from pyspark.ml import Pipeline

    theirs = Pipeline(stages=list(training.forest_stages(PARAMS))).fit(planted)
    theirs.write().save(str(tmp_path / "theirs"))
    expected = {r["k"]: r["prediction"] for r in theirs.transform(planted).collect()}
    ours = training.load_model(str(tmp_path / "theirs"))
    assert {r["k"]: r["prediction"] for r in training.score(ours, planted, PARAMS).collect()} == pytest.approx(expected, abs=1e-9)
    # Grown here on the same rows, the forest errs no more.
    error = lambda model: training.score(model, planted, PARAMS).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert error(training.train_forest(planted, PARAMS)) < 1.2 * error(ours)


def test_the_same_rows_give_the_same_forest_wherever_they_lie(spark, planted):
    forests = [
        sorted(map(tuple, training.train_forest(df, PARAMS, ["k"]).nodes.collect()), key=lambda node: node[:2])
        for df in (planted.repartition(5), planted.orderBy(F.desc("a")).coalesce(1))
    ]
    assert repr(forests[0]) == repr(forests[1])


def test_a_forest_needs_rows_and_takes_one(spark, planted):
    with pytest.raises(ValidationError, match="no row"):
        training.train_forest(planted.where("k < 0"), PARAMS)
    model = training.train_forest(planted.where("k = 3"), PARAMS)
    assert model.depths() == [(0, 1)] * 7 and set(model.importances()) == {0.0}
    [answer] = {r["prediction"] for r in training.score(model, planted, PARAMS).collect()}
    assert answer == pytest.approx(planted.where("k = 3").first()["y"])
