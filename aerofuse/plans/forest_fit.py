"""A random forest grown from all its rows: they are binned once, and each tree sweeps its bootstrap sample in one task.

The trees are those that Spark ML declares: every feature at every split, the largest fall of the variance, Poisson(1)
copies of every row. Borders of bins come from all rows, too: from their distinct values, or a sketch over all of them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.params import ForestParams
from aerofuse.session import materialize

NODES = ("tree int, node int, feature int, threshold double, below int, above int, prediction double, impurity double, "
         "gain double, count long, total double, squares double")
CELLS = 1 << 16  # cells of the histograms that a task sums at once
NODE_ROWS = 100_000  # nodes in a batch that a task hands back

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so the tasks need no package


def bin_borders(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """For each feature at most ``bins - 1`` rising borders; a value belongs to the first that it does not exceed.

    Up to ``bins`` distinct values are told apart, each; of more, the quantiles are taken.
    """
    steps = [i / bins for i in range(1, bins)]
    parts = [(F.percentile_approx(f, steps, 10_000).alias(f"q{i}"), F.approx_count_distinct(f).alias(f"n{i}")) for i, f in enumerate(features)]
    found = rows.agg(*(c for pair in parts for c in pair)).first()
    borders = []
    for i, f in enumerate(features):
        values = None
        if found[f"n{i}"] <= 2 * bins:  # the estimate may err
            values = np.array(sorted(r[0] for r in rows.select(f).distinct().limit(bins + 1).collect()), dtype=np.float64)
        if values is None or len(values) > bins:
            borders.append(np.unique(np.array(found[f"q{i}"], dtype=np.float64)))
            continue
        low, high = values[:-1], values[1:]
        with np.errstate(invalid="ignore"):
            middle = low / 2 + high / 2
        borders.append(np.where((middle >= low) & (middle < high), middle, low))
    return borders


def _code_type(borders: Sequence[np.ndarray]) -> np.dtype:
    return np.dtype(np.uint8 if max(map(len, borders)) < 256 else np.uint16)


def binned(rows: DataFrame, features: Sequence[str], target: str, borders: Sequence[np.ndarray], key: Sequence[str] = ()) -> DataFrame:
    """``row``, the codes of the features packed into longs, and ``y``; written once, so that a row keeps its number.

    With a key, the number follows from the key and the values, wherever the row lies; else from its place.
    """
    code = _code_type(borders)
    per = 8 // code.itemsize
    longs = -(-len(features) // per)
    schema = ", ".join(["row long", *(f"c{i} long" for i in range(longs)), "y double"])
    names = [field.split()[0] for field in schema.split(", ")]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, longs * per), dtype=code)
            for i, border in enumerate(borders):
                codes[:, i] = np.searchsorted(border, batch.column(i + 1).to_numpy(), side="left")
            packed = codes.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(packed[:, i].copy()) for i in range(longs)), batch.column(len(borders) + 1)], names=names)

    number = F.xxhash64(*key, *features, target) if key else F.monotonically_increasing_id()
    plain = rows.select(number.alias("row"), *(F.col(f).cast("double") for f in features), F.col(target).cast("double"))
    return materialize(plain.mapInArrow(pack, schema), "binned")


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64: 64 bits that look drawn, the same for the same number."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Where the upper 53 bits of a draw begin to stand for one copy more.
_POISSON = (np.cumsum([exp(-1) / factorial(k) for k in range(16)]) * 2.0**53).astype(np.uint64)


def copies(row: np.ndarray, tree: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a tree's bootstrap sample, and how often each is in it."""
    salt = _mixed(_mixed(np.array([seed & (1 << 64) - 1], dtype=np.uint64)) + np.uint64(tree))
    drawn = _mixed(row.view(np.uint64) ^ salt) >> np.uint64(11)
    kept = np.flatnonzero(drawn >= _POISSON[0])
    if not len(kept):  # as may be with a handful of rows
        return np.arange(len(row)), np.ones(len(row))
    return kept, np.searchsorted(_POISSON, drawn[kept], side="right").astype(np.float64)


def _best_splits(codes: np.ndarray, node: np.ndarray, w: np.ndarray, wy: np.ndarray, count: np.ndarray, total: np.ndarray,
                 widths: Sequence[int], min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1 if there is none), last code below and fall of the sum of squares for each node. Rows lie by node."""
    nodes = len(count)
    feature, last, fall = np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.full(nodes, -np.inf)
    ends = np.searchsorted(node, np.arange(nodes + 1))
    step = max(1, CELLS // max(widths))
    for a in range(0, nodes, step):
        b = min(a + step, nodes)
        part = slice(ends[a], ends[b])
        local, n, t = node[part] - a, count[a:b, None], total[a:b, None]
        for f, width in enumerate(widths):
            if width < 2:
                continue
            cell = local * width + codes[part, f]
            below = np.bincount(cell, w[part], (b - a) * width).reshape(b - a, width)[:, :-1].cumsum(axis=1)
            summed = np.bincount(cell, wy[part], (b - a) * width).reshape(b - a, width)[:, :-1].cumsum(axis=1)
            above = n - below
            score = summed * summed / below + (t - summed) ** 2 / above
            score[(below < min_leaf) | (above < min_leaf)] = -np.inf
            at = score.argmax(axis=1)
            best = score[np.arange(b - a), at]
            better = np.flatnonzero(best > fall[a:b])
            feature[a + better], last[a + better], fall[a + better] = f, at[better], best[better]
    return feature, last, fall - total * total / count


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, widths: Sequence[int], max_depth: int, min_leaf: int) -> dict[str, np.ndarray]:
    """The nodes of one tree, level by level; rows leave with the leaves they fall into."""
    middle = np.average(y, weights=w)  # sums of squares lose less about it
    y = y - middle
    wy, node = w * y, np.zeros(len(y), dtype=np.int64)
    levels, first, children, starts = [], 0, 1, np.zeros(1, dtype=np.int64)
    for depth in range(max_depth + 1):
        count, total = np.bincount(node, w, children), np.bincount(node, wy, children)
        squares = np.bincount(node, wy * y, children)
        level = {
            "feature": np.full(children, -1), "last": np.zeros(children, dtype=np.int64), "below": np.full(children, -1),
            "above": np.full(children, -1), "gain": np.full(children, -1.0), "count": count,
            "prediction": total / count + middle, "impurity": np.maximum(squares / count - (total / count) ** 2, 0.0),
            "total": total + middle * count, "squares": squares + 2 * middle * total + middle * middle * count,
        }
        levels.append(level)
        if depth == max_depth:
            break
        mixed = np.minimum.reduceat(y, starts) < np.maximum.reduceat(y, starts)
        tried = np.flatnonzero(mixed & (count >= 2 * min_leaf))
        if not len(tried):
            break
        number = np.full(children, -1)
        number[tried] = np.arange(len(tried))
        node = number[node]
        codes, y, w, wy, node = (v[node >= 0] for v in (codes, y, w, wy, node))
        feature, last, fall = _best_splits(codes, node, w, wy, count[tried], total[tried], widths, min_leaf)
        split = np.flatnonzero((feature >= 0) & (fall > 1e-13 * squares[tried]))
        if not len(split):
            break
        at, first = tried[split], first + children
        level["feature"][at], level["last"][at] = feature[split], last[split]
        level["gain"][at] = fall[split] / count[at]
        level["below"][at], level["above"][at] = first + np.arange(len(split)), first + len(split) + np.arange(len(split))
        # The lower children of all nodes come first, so the rows of a child stay together without a sort.
        number = np.full(len(tried), -1)
        number[split] = np.arange(len(split))
        low = codes[np.arange(len(node)), feature[node]] <= last[node]
        child = number[node]
        order = np.concatenate([np.flatnonzero(low & (child >= 0)), np.flatnonzero(~low & (child >= 0))])
        node = np.where(low, child, child + len(split))[order]
        codes, y, w, wy = codes[order], y[order], w[order], wy[order]
        children = 2 * len(split)
        starts = np.searchsorted(node, np.arange(children))
    return {c: np.concatenate([level[c] for level in levels]) for c in levels[0]}


def _growing(trees: range, rows: int, borders: Sequence[np.ndarray], max_depth: int, min_leaf: int,
             seed: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All binned rows to the nodes of some trees, one tree after the other."""
    code, widths = _code_type(borders), [len(b) + 1 for b in borders]
    names = [field.split()[0] for field in NODES.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    kinds = [types[field.split()[1]] for field in NODES.split(", ")]
    limits = np.full((len(borders), max(widths)), np.nan)
    for i, border in enumerate(borders):
        limits[i, :len(border)] = border

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, y, packed, seen = np.empty(rows, dtype=np.int64), np.empty(rows), None, 0
        for batch in batches:
            part = slice(seen, seen + batch.num_rows)
            longs = [c.to_numpy() for c in batch.columns[1:-1]]
            packed = np.empty((rows, len(longs)), dtype=np.int64) if packed is None else packed
            row[part], y[part], seen = batch.column(0).to_numpy(), batch.column(batch.num_columns - 1).to_numpy(), part.stop
            for i, values in enumerate(longs):
                packed[part, i] = values
        if seen != rows:
            raise ValueError(f"{seen} rows were read, {rows} were counted")
        order = np.argsort(row, kind="stable")  # sums do not depend on where the rows lie
        row, y, codes = row[order], y[order], packed[order].view(code)
        del packed, order
        for tree in trees:
            kept, w = copies(row, tree, seed)
            with np.errstate(divide="ignore", invalid="ignore"):
                nodes = grow(codes[kept], y[kept], w, widths, max_depth, min_leaf)
            size = len(nodes["feature"])
            inner = nodes["feature"] >= 0
            nodes |= {"tree": np.full(size, tree), "node": np.arange(size)}
            nodes["threshold"] = np.where(inner, limits[np.where(inner, nodes["feature"], 0), nodes["last"]], np.nan)
            table = pa.RecordBatch.from_arrays([pa.array(nodes[n]).cast(k, safe=False) for n, k in zip(names, kinds, strict=True)], names=names)
            for begin in range(0, size, NODE_ROWS):
                yield table.slice(begin, NODE_ROWS)

    return work


def grow_forest(rows: DataFrame, features: Sequence[str], target: str, forest: ForestParams, counted: int, key: Sequence[str] = ()) -> DataFrame:
    """The nodes of all trees, written once. ``rows`` must be complete, ``counted`` of them.

    A task reads the binned rows for all its trees; it holds 24 bytes of each row for eight features, twice for a moment, and
    while a tree grows about 75 bytes of each row of its sample.
    """
    borders = bin_borders(rows, features, forest.max_bins)
    table = binned(rows, features, target, borders, key)
    tasks = min(forest.trees, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    ends = [forest.trees * i // tasks for i in range(tasks + 1)]
    # Spark lays a union of members of one partition each into one; an empty member that is not coalesced keeps them apart.
    grown = table.where("row < 0").mapInArrow(lambda batches: iter(()), NODES)
    for a, b in zip(ends, ends[1:]):
        work = _growing(range(a, b), counted, borders, forest.max_depth, forest.min_leaf, forest.seed)
        grown = grown.union(table.coalesce(1).mapInArrow(work, NODES))
    return materialize(grown, "forest")
