"""A fitted forest: its nodes as a table, answers by walking them, kept and read in the format of Spark ML."""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.plans.forest_table import tree_blocks
from aerofuse.session import materialize, small_table

BLOCK_NODES = 1_000_000  # nodes that the driver gathers at once
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so the tasks need no package


def _laid_out(node: np.ndarray, feature: np.ndarray, threshold: np.ndarray, below: np.ndarray, above: np.ndarray,
              prediction: np.ndarray) -> Tree:
    """Feature (-1 for a leaf), threshold or answer, and place of the lower child, which the upper one follows."""
    order = np.argsort(node)
    inner = order[below[order] >= 0]
    at = np.zeros(len(node), dtype=np.int64)
    position = np.empty(len(node), dtype=np.int64)
    position[node] = np.arange(len(node))
    children = 1 + 2 * np.arange(len(inner))
    at[position[below[inner]]], at[position[above[inner]]] = children, children + 1
    leaf = below < 0
    kind, value, child = np.empty(len(node), dtype=np.int16), np.empty(len(node)), np.zeros(len(node), dtype=np.int32)
    kind[at], value[at] = np.where(leaf, -1, feature), np.where(leaf, prediction, threshold)
    child[at[inner]] = children
    return kind, value, child


def _depth(tree: Tree) -> int:
    kind, _, child = tree
    level, depth = np.zeros(1, dtype=np.int64), 0
    while len(level := level[kind[level] >= 0]):
        level, depth = np.concatenate([child[level], child[level] + 1]), depth + 1
    return depth


def _mean(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """The mean over the trees of the leaf that each row falls into."""
    total, width = np.zeros(len(x)), x.shape[1]
    for kind, value, child in trees:
        at = np.zeros(len(x), dtype=np.int64)
        going = np.flatnonzero(kind[at] >= 0)
        while len(going):
            here = at[going]
            low = x.take(going * width + kind.take(here)) <= value.take(here)
            here = child.take(here) + ~low
            at[going] = here
            going = going[kind.take(here) >= 0]
        total += value.take(at)
    return total / len(trees)


def _walk(trees: Sequence[Tree]) -> Callable[..., Column]:
    def walk(row: pa.Array) -> pa.Array:
        if not len(row):
            return pa.array([], pa.float64())
        return pa.array(_mean(trees, np.column_stack([row.field(i).to_numpy(zero_copy_only=False) for i in range(row.type.num_fields)])))

    walk.__annotations__ = {"row": pa.Array, "return": pa.Array}
    return F.arrow_udf(walk, "double")


class ForestModel:
    """``nodes`` as laid down by ``forest_fit.NODES``; ``kept`` holds what Spark ML writes beside them."""

    def __init__(self, nodes: DataFrame, assembler: VectorAssembler, kept: dict) -> None:
        self.nodes, self.assembler, self.kept = nodes, assembler, kept
        self._trees: list[Tree] | None = None
        self._answer: Callable[..., Column] | None = None

    @property
    def features(self) -> list[str]:
        return self.assembler.getInputCols()

    def trees(self) -> list[Tree]:
        """All trees, 14 bytes a node; gathered in blocks."""
        if self._trees is None:
            self._trees = []
            columns = ("node", "feature", "threshold", "below", "above", "prediction")
            for first, last in tree_blocks(self.nodes, BLOCK_NODES):
                block = self.nodes.where(F.col("tree").between(first, last)).select("tree", *columns).toArrow()
                tree = block["tree"].to_numpy()
                order = np.argsort(tree, kind="stable")
                starts = np.searchsorted(tree[order], np.arange(first, last + 2))
                whole = [block[c].to_numpy() for c in columns]
                for a, b in zip(starts, starts[1:]):
                    self._trees.append(_laid_out(*(c[order[a:b]] for c in whole)))
        return self._trees

    def depths(self) -> list[tuple[int, int]]:
        """Depth and number of nodes of each tree."""
        return [(_depth(tree), len(tree[0])) for tree in self.trees()]

    def answer(self) -> Column:
        """The mean over the trees; the features must be there."""
        if self._answer is None:
            self._answer = _walk(self.trees())
        return self._answer(F.struct(*(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(self.features))))

    def importances(self) -> np.ndarray:
        """The fall of the impurity that each feature brings, shares of each tree, averaged as Spark ML does."""
        falls = self.nodes.where("below >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("count")).alias("fall"))
        shares = np.zeros((self.kept["numTrees"], len(self.features)))
        for tree, feature, fall in falls.collect():  # a row a tree and feature
            shares[tree, feature] = fall
        sums = shares.sum(axis=1, keepdims=True)
        weights = np.divide(shares, sums, out=np.zeros_like(shares), where=sums > 0).sum(axis=0)
        return weights / (weights.sum() or 1.0)

    def write(self) -> ForestWriter:
        return ForestWriter(self)


class ForestWriter:
    """Writes what ``PipelineModel.load`` reads."""

    def __init__(self, model: ForestModel) -> None:
        self.model, self.over = model, False

    def overwrite(self) -> ForestWriter:
        self.over = True
        return self

    def save(self, path: str) -> None:
        model, spark = self.model, self.model.nodes.sparkSession
        writer = PipelineModel([model.assembler]).write()
        (writer.overwrite() if self.over else writer).save(path)
        pipeline = _read_json(spark, f"{path}/metadata")
        stage = f"{path}/stages/1_{model.kept['uid']}"
        forest = model.kept | {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        of_tree = {k: v for k, v in forest["paramMap"].items() if k not in ("numTrees", "featureSubsetStrategy", "bootstrap", "subsamplingRate")}
        tree = {**forest, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": of_tree, "defaultParamMap": {}}
        tree.pop("numTrees")
        _write_json(spark, f"{stage}/metadata", forest)
        rows = [(i, json.dumps(tree | {"uid": f"dtr_{model.kept['uid']}_{i}"}), 1.0) for i in range(forest["numTrees"])]
        small_table(spark, rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{stage}/treesMetadata")
        inner = F.col("below") >= 0
        split = F.struct(
            F.when(inner, F.col("feature")).otherwise(-1).alias("featureIndex"),
            F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories"))
        model.nodes.select(F.col("tree").alias("treeID"), F.struct(
            F.col("node").alias("id"), "prediction", "impurity",
            F.array(F.col("count").cast("double"), "total", "squares").alias("impurityStats"), F.col("count").alias("rawCount"), "gain",
            F.col("below").alias("leftChild"), F.col("above").alias("rightChild"), split.alias("split")).alias("nodeData"),
        ).write.parquet(f"{stage}/data")
        # Last, so that a folder without its nodes names no forest.
        pipeline["paramMap"]["stageUids"] = [model.assembler.uid, model.kept["uid"]]
        _write_json(spark, f"{path}/metadata", pipeline)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path).collect()))  # one line


def _write_json(spark: SparkSession, path: str, content: dict) -> None:
    small_table(spark, [(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def declared(forest: RandomForestRegressor, features: int) -> dict:
    """What Spark ML keeps of a forest beside its nodes."""
    values = {p.name: forest.getOrDefault(p) for p in forest.params if forest.isDefined(p)}
    return {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "uid": forest.uid, "paramMap": values,
            "defaultParamMap": {}, "numFeatures": features, "numTrees": forest.getNumTrees()}


def load_forest(path: str) -> ForestModel:
    """A forest that was kept here or by Spark ML, behind an assembler. Its nodes are copied: the folder may be written anew."""
    spark = SparkSession.active()
    assembler, forest = _read_json(spark, f"{path}/metadata")["paramMap"]["stageUids"]
    stage, node = f"{path}/stages/1_{forest}", F.col("nodeData")
    data = spark.read.parquet(f"{stage}/data")
    nodes = data.select(
        F.col("treeID").alias("tree"), node.id.alias("node"), node.split.featureIndex.alias("feature"),
        F.get(node.split.leftCategoriesOrThreshold, F.lit(0)).alias("threshold"), node.leftChild.alias("below"),
        node.rightChild.alias("above"), node.prediction.alias("prediction"), node.impurity.alias("impurity"), node.gain.alias("gain"),
        node.impurityStats[0].cast("long").alias("count"), node.impurityStats[1].alias("total"), node.impurityStats[2].alias("squares"))
    return ForestModel(
        materialize(nodes, "forest"), VectorAssembler.load(f"{path}/stages/0_{assembler}"), _read_json(spark, f"{stage}/metadata"))
