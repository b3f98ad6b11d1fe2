"""Fit, score and evaluate the declared forest.

The forest is fitted once per session and input, on all training rows, and shared by the queries. As the forest itself
is beyond SQL, the statements say what must hold of it whatever the trees are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.catalog.fixtures import spark_view, with_views
from aerofuse.catalog.scans import landing_path
from aerofuse.operators.split import split
from aerofuse.operators.summaries import regression_metrics
from aerofuse.params import FEATURES, TrainingParams
from aerofuse.plans import training
from aerofuse.plans.forest_model import ForestModel
from aerofuse.plans.forest_table import forest_nodes, score_by_nodes
from aerofuse.plans.preprocess import preprocess
from aerofuse.session import materialize, prepare, small_table
from aerofuse.sources import load_metrics, save_metrics

PARAMS = TrainingParams()
KEY = ("event_id",)

Fitted = tuple[ForestModel, DataFrame]
_fits: dict[tuple[str, str], Fitted] = {}


def fitted(spark: SparkSession, sf_dir: str) -> Fitted:
    """The forest and the prepared table it was fitted on, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fits:
        prepare(spark)
        features = spark_view(spark, sf_dir, "features")
        # Written once, because the split, the fit and the scoring all read it.
        ready = materialize(
            preprocess(features, PARAMS, order_by=("time", "event_id"), partition_by=("station_id",)), "prepared"
        )
        train, _ = split(ready, PARAMS, KEY)
        _fits[key] = training.train_forest(train, PARAMS, KEY), ready
    return _fits[key]


def in_range(column: str, ready: DataFrame) -> Column:
    """A forest answers with means of target values, so it stays between their ends; False where it is NULL."""
    low, high = ready.agg(F.min(PARAMS.target), F.max(PARAMS.target)).first()
    slack = 1e-9 * max(abs(low), abs(high), 1.0)
    return F.coalesce(F.col(column).between(low - slack, high + slack), F.lit(False))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = with_views(sql, ("features",))
        return function

    return register


# The test rows: the fifth of the rows with a target whose digest ranks lowest.
TEST_SQL = """
    , ready AS (SELECT * FROM features WHERE pm25 IS NOT NULL),
    ranked AS (
        SELECT *, row_number() OVER (ORDER BY md5(concat_ws('-', CAST(event_id AS VARCHAR), '42'))) AS place FROM ready),
    test AS (SELECT * FROM ranked WHERE place <= ceil((SELECT count(*) FROM ready) * 0.2))"""


@_query("""
    SELECT CAST(range AS INTEGER) AS tree, true AS within_depth, true AS has_nodes FROM range(0, 300)""")
def rf_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = fitted(spark, sf_dir)
    rows = [(i, depth <= PARAMS.forest.max_depth, nodes >= 1) for i, (depth, nodes) in enumerate(model.depths())]
    return small_table(spark, rows, "tree int, within_depth boolean, has_nodes boolean")


@_query(f"""{TEST_SQL}
    SELECT event_id, station_id, pm25, true AS in_range FROM test""")
def rf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ready = fitted(spark, sf_dir)
    _, test = split(ready, PARAMS, KEY)
    scored = training.score(model, test, PARAMS)
    return scored.select("event_id", "station_id", "pm25", in_range("prediction", ready).alias("in_range"))


@_query(f"""{TEST_SQL}
    SELECT event_id, CAST(time AS DATE) AS date, true AS in_range FROM test""")
def score_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ready = fitted(spark, sf_dir)
    _, test = split(ready, PARAMS, KEY)
    path = landing_path(ready, "scores")
    training.score_file(model, test, path, PARAMS)
    kept = spark.read.schema(test.schema.add("predicted_pm25", "double")).parquet(path)
    return kept.select("event_id", F.to_date("time").alias("date"), in_range("predicted_pm25", ready).alias("in_range"))


@_query(f"""
    SELECT unnest([{', '.join(f"'{f}'" for f in FEATURES)}]) AS feature, true AS is_weight, 1.0::DOUBLE AS total""")
def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ready = fitted(spark, sf_dir)
    weights = training.feature_importance(model, PARAMS.features, ready)
    total = weights.agg(F.round(F.sum("importance"), 6).alias("total"))
    return weights.select("feature", (F.col("importance") >= 0).alias("is_weight")).join(F.broadcast(total))


@_query("""
    SELECT CAST(range AS INTEGER) AS place, true AS falling FROM range(1, 6)""")
def importance_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ready = fitted(spark, sf_dir)
    top = training.top_importances(training.feature_importance(model, PARAMS.features, ready))
    # Five rows, so they may be numbered where they are printed.
    weights = [row["importance"] for row in top.collect()]
    rows = [(i + 1, i == 0 or weights[i - 1] >= w) for i, w in enumerate(weights)]
    return small_table(spark, rows, "place int, falling boolean")


# A target that the features make up, most of it by one of them, and noise that no feature knows.
PLANTED_SQL = """20 * coalesce(aod, 0) + coalesce(humidity, 0) / 1e1 + (event_id * 7919 % 101) / 1e2"""


@_query(f"""
    , planted AS (SELECT event_id, {PLANTED_SQL} AS y FROM features),
    ranked AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('-', CAST(event_id AS VARCHAR), '42'))) AS place FROM planted),
    test AS (SELECT * FROM ranked WHERE place <= ceil((SELECT count(*) FROM planted) * 0.2))
    SELECT event_id, round(y, 6) AS y, true AS same_by_nodes, 'aod' AS leader, true AS explains FROM test""")
def forest_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared forest on a planted target: what it answers is what its nodes say, the planted feature leads, and
    the error on rows that the fit has not seen is below a fifth of the target's deviation."""
    prepare(spark)
    planted = spark_view(spark, sf_dir, "features").select(
        "event_id", F.expr(PLANTED_SQL).cast("double").alias("y"), *(F.coalesce(f, F.lit(-1.0)).alias(f) for f in FEATURES if f != "day_of_year"),
        F.dayofyear("time").alias("day_of_year"))
    params = TrainingParams(target="y")
    ready = materialize(planted, "planted")
    train, test = split(ready, params, KEY)
    model = training.train_forest(train, params, KEY)
    path = f"{landing_path(ready, 'planted')}/model"
    model.write().save(path)
    scored = materialize(training.score(model, test, params), "planted-scores")
    by_nodes = score_by_nodes(test, forest_nodes(spark, path), params.features, KEY)
    leader = training.top_importances(training.feature_importance(model, params.features, ready), 1).select(F.col("feature").alias("leader"))
    error = regression_metrics(scored, "y").select("rmse").join(F.broadcast(scored.agg(F.stddev_pop("y").alias("deviation"))))
    proof = error.select((F.col("rmse") < F.col("deviation") / 5).alias("explains")).join(F.broadcast(leader))  # one row each
    return scored.join(by_nodes, list(KEY), "left").join(F.broadcast(proof)).select(
        "event_id", F.round("y", 6).alias("y"),
        F.coalesce(F.abs(F.col("prediction") - F.col("by_nodes")) < 1e-9, F.lit(False)).alias("same_by_nodes"), "leader", "explains")


@_query(f"""{TEST_SQL}
    SELECT count(*) AS test_rows, true AS ordered, true AS same_when_loaded FROM test""")
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors over all test rows, kept with the model; measured again with what is read back."""
    model, ready = fitted(spark, sf_dir)
    _, test = split(ready, PARAMS, KEY)
    output = landing_path(ready, "training")
    model.write().overwrite().save(f"{output}/model")
    save_metrics(regression_metrics(training.score(model, test, PARAMS), PARAMS.target), f"{output}/metrics")
    again = training.score(training.load_model(f"{output}/model"), test, PARAMS)
    measured = regression_metrics(again, PARAMS.target).select(*(F.col(c).alias(f"{c}_again") for c in ("rmse", "mae", "r2")))
    kept = load_metrics(spark, f"{output}/metrics")
    same = [F.abs(F.col(c) - F.col(f"{c}_again")) < 1e-9 for c in ("rmse", "mae", "r2")]
    rows = again.agg(F.count("*").alias("test_rows"))
    return rows.join(F.broadcast(kept)).join(F.broadcast(measured)).select(
        "test_rows",
        ((F.col("rmse") >= F.col("mae")) & (F.col("mae") >= 0)).alias("ordered"),
        (same[0] & same[1] & same[2]).alias("same_when_loaded"),
    )
