"""Random forest regression: fit, score, evaluate, keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.operators.split import rows_to_fit, split
from aerofuse.operators.summaries import regression_metrics
from aerofuse.params import TrainingParams
from aerofuse.plans.forest_fit import grow_forest
from aerofuse.plans.forest_model import ForestModel, declared, load_forest
from aerofuse.session import shared_folder, small_table
from aerofuse.sources.rules import ValidationError, require_columns
from aerofuse.sources.sinks import save_metrics, write_table


def forest_stages(params: TrainingParams) -> tuple[VectorAssembler, RandomForestRegressor]:
    """The forest as Spark ML declares it: all features are tried at every split and every tree sees a bootstrap sample.

    A leaf of at least two rows implies that only nodes of four or more rows are split.
    """
    forest = params.forest
    return (
        VectorAssembler(inputCols=list(params.features), outputCol="_features", handleInvalid="error"),
        RandomForestRegressor(
            featuresCol="_features",
            labelCol=params.target,
            predictionCol="prediction",
            numTrees=forest.trees,
            maxDepth=forest.max_depth,
            minInstancesPerNode=forest.min_leaf,
            maxBins=forest.max_bins,
            featureSubsetStrategy="all",
            bootstrap=True,
            seed=forest.seed,
        ),
    )


def train_forest(train: DataFrame, params: TrainingParams = TrainingParams(), key: Sequence[str] = ()) -> ForestModel:
    """Fit on all rows, by the feature and target columns only; they are kept for the passes before the rows are binned.

    Rows must be complete; the columns that have gaps are named before the fit starts. With a ``key`` that tells rows
    apart, the samples of the trees do not depend on where the rows lie.
    """
    require_columns(train, [*params.features, params.target, *key])
    fitted = [*params.features, params.target]
    numbers = [F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]
    narrow = train.select(*(F.col(c).cast("double").alias(c) for c in fitted), *numbers)
    narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gaps = narrow.agg(F.count("*"), *(F.count_if(F.col(c).isNull() | F.isnan(F.col(c))).alias(c) for c in fitted))
        rows, *missing = gaps.first()
        open_columns = [c for c, n in zip(fitted, missing, strict=True) if n]
        if open_columns:
            raise ValidationError(f"Columns with missing values cannot be fitted: {', '.join(open_columns)}")
        if not rows:
            raise ValidationError("There is no row to fit")
        assembler, forest = forest_stages(params)
        nodes = grow_forest(narrow, params.features, params.target, params.forest, rows, narrow.columns[len(fitted):])
        return ForestModel(nodes, assembler, declared(forest, len(params.features)))
    finally:
        narrow.unpersist()


def score(model: ForestModel, df: DataFrame, params: TrainingParams = TrainingParams(),
          name: str = "prediction") -> DataFrame:
    """Predictions next to the rows they belong to; NULL where a feature is missing. Works on a stream too."""
    needed = list(dict.fromkeys([*params.features, *model.features]))
    require_columns(df, needed)
    complete = reduce(and_, (F.col(f).isNotNull() for f in needed))
    return df.withColumn(name, F.when(complete, model.answer()))


def feature_frame(spark: SparkSession, request: Mapping[str, Sequence[float]],
                  params: TrainingParams = TrainingParams()) -> DataFrame:
    """A request of equally long lists, one per feature, as rows with their position ``row``."""
    absent = [f for f in params.features if f not in request]
    if absent:
        raise ValidationError(f"The request lacks {', '.join(absent)}")
    columns = [request[f] for f in params.features]
    rows = [(i, *map(float, values)) for i, values in enumerate(zip(*columns, strict=True))]
    return small_table(spark, rows, ", ".join(["row int", *(f"{f} double" for f in params.features)]))


def score_file(model: ForestModel, df: DataFrame, path: str, params: TrainingParams = TrainingParams(),
               file_format: str = "parquet") -> None:
    write_table(score(model, df, params, "predicted_pm25"), path, file_format, mode="overwrite")


def feature_importance(model: ForestModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance) by impurity decrease; one row per feature."""
    weights = model.importances()
    rows = [(f, float(w)) for f, w in zip(features, weights, strict=True)]
    return small_table(df.sparkSession, rows, "feature string, importance double")


def top_importances(importances: DataFrame, n: int = 5) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def train_and_evaluate(df: DataFrame, key: Sequence[str], params: TrainingParams = TrainingParams(),
                       output: str | None = None) -> tuple[ForestModel, DataFrame]:
    """Split, fit, score the test rows and measure; with ``output`` keep model and metrics there."""
    train, test = split(df, params, key)
    model = train_forest(rows_to_fit(train, params, key), params, key)
    metrics = regression_metrics(score(model, test, params), params.target)
    if output is not None:
        model.write().overwrite().save(f"{output}/model")
        save_metrics(metrics, f"{output}/metrics")
    return model, metrics


def load_model(path: str) -> ForestModel:
    return load_forest(path)
