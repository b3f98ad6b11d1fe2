"""A fitted forest as a table of nodes, and scoring by them: what the model answers, without the model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse.session import BROADCAST_ROWS, materialize


def forest_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """tree, node, feature, threshold, below, above, prediction of a pipeline kept with a forest as its last stage.

    A leaf has no feature. Features are numbered from 0 and continuous.
    """
    kept = spark.read.parquet(f"{model_path}/stages/*_RandomForestRegressor_*/data")
    inner = F.col("nodeData.leftChild") >= 0
    return kept.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner, F.col("nodeData.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("nodeData.leftChild").alias("below"), F.col("nodeData.rightChild").alias("above"), F.col("nodeData.prediction").alias("prediction"))


def _by_position(nodes: pa.Table) -> list[np.ndarray]:
    """Roots, then feature, threshold, below and above in turn, leaf or not, and prediction of nodes by position."""
    column = {c: nodes[c].to_numpy() for c in nodes.column_names}
    tree = column["tree"].astype(np.int64) << 32
    order = np.argsort(tree | column["node"])
    tree, column = tree[order], {c: v[order] for c, v in column.items()}
    named, leaf = tree | column["node"], np.isnan(column["feature"].astype(np.float64))
    children = np.column_stack([np.searchsorted(named, tree | np.where(leaf, 0, column[c])) for c in ("below", "above")])
    return [np.flatnonzero(column["node"] == 0), np.where(leaf, 0, column["feature"]).astype(np.int64),
            column["threshold"].astype(np.float64), children.ravel(), leaf, column["prediction"]]


def _descent(nodes: pa.Table, keys: int, names: Sequence[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of keys and features to keys, the sum of the leaves met and the number of trees. Sent to the tasks by value."""
    roots, feature, threshold, children, leaf, prediction = _by_position(nodes)

    def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[keys:]])
            total, width = np.zeros(len(x)), x.shape[1]
            for root in roots:
                at = np.full(len(x), root)
                going = np.flatnonzero(~leaf.take(at))
                while len(going):
                    here = at[going]
                    low = x.take(going * width + feature.take(here)) <= threshold.take(here)
                    here = children.take(2 * here + ~low)
                    at[going] = here
                    going = going[~leaf.take(here)]
                total += prediction.take(at)
            found = [pa.array(total), pa.array(np.full(len(x), len(roots)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keys], *found], names=names)

    return descend


def tree_blocks(nodes: DataFrame, most: int) -> list[tuple[int, int]]:
    """First and last tree of blocks that hold at most ``most`` nodes each, or one tree."""
    blocks: list[tuple[int, int]] = []
    held = 0
    for tree, n in sorted(map(tuple, nodes.groupBy("tree").count().collect())):  # a row a tree
        if not blocks or held + n > most:
            blocks.append((tree, tree))
            held = 0
        blocks[-1], held = (blocks[-1][0], tree), held + n
    return blocks


def score_by_nodes(df: DataFrame, nodes: DataFrame, features: Sequence[str], key: Sequence[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """``key`` and ``by_nodes``: the mean over the trees of the leaf that each row falls into.

    ``key`` must identify a row, rows must be complete. Rows stay whole and go down all trees in one task, a batch at a
    time; no row is multiplied by the trees. Nodes are sent to the tasks, at most ``most`` of them for one pass over the rows:
    a larger forest takes a pass for each block of trees, so neither driver nor tasks hold more than a block.
    """
    nodes = materialize(nodes, "nodes")
    values = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    rows = df.select(*key, *values).repartition(*key)
    schema = T.StructType([*rows.schema.fields[:len(key)], T.StructField("total", T.DoubleType()), T.StructField("trees", T.LongType())])

    def part(first: int, last: int) -> DataFrame:
        some = nodes.where(F.col("tree").between(first, last)).toArrow()
        return rows.mapInArrow(_descent(some, len(key), schema.names), schema)

    first, *others = [part(*block) for block in tree_blocks(nodes, most)]
    for other in others:
        first = first.unionByName(other)
    mean = (F.sum("total") / F.sum("trees")).alias("by_nodes")
    return materialize(first.groupBy(*key).agg(mean), "by-nodes")
