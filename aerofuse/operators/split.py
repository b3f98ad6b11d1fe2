"""Exact, reproducible train/test splits without sorting or moving the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.ordering import FEW, first_rows
from aerofuse.params import TrainingParams
from aerofuse.session import micros

DIGITS = 3  # hex digits that a pass of a search tells apart


def _digest(key: Sequence[str], seed: int) -> Column:
    """A 128-bit digest of the row key as hex text, which sorts like the number. Never NULL."""
    return F.md5(F.concat_ws("-", *(F.col(k).cast("string") for k in key), F.lit(str(seed))))


def _cut(df: DataFrame, digest: Column, wanted: Callable[[int], int], few: int = FEW) -> tuple[int, str | None]:
    """The rows of ``df``, and the digest that the first ``wanted(rows)`` of them do not exceed; None if there is no such row.

    Found by counting rows by the digits they begin with, at most 4,096 counts for a pass. Digests are even, so the
    second pass lists what is left of one count; more than ``few`` rows are counted by further digits instead.
    """
    digests = df.select(digest.alias("digest"))
    start, below, total, rank = "", 0, None, 0
    while True:
        inside = digests.where(F.col("digest").startswith(start))
        counts = sorted(map(tuple, inside.groupBy(F.substring("digest", 1, len(start) + DIGITS)).count().collect()))
        if total is None:
            total = sum(n for _, n in counts)
            rank = wanted(total) - 1
            if not 0 <= rank < total:
                return total, None
        for start, n in counts:
            if rank < below + n:
                break
            below += n
        if len(start) == 32:
            return total, start
        if n <= few:
            return total, sorted(r["digest"] for r in digests.where(F.col("digest").startswith(start)).collect())[rank - below]


def mark_test(df: DataFrame, params: TrainingParams, key: Sequence[str], time: str = "time",
              name: str = "is_test") -> DataFrame:
    """Mark exactly ``ceil(n * test_size)`` rows as test rows.

    Shuffled: the rows whose digest ranks lowest. Ordered: the latest rows. ``key`` must identify a
    row (integers, for the ordered split). The boundary is found by counting, so the rows stay where
    they are and the marking is a filter that can be fused into any later scan.
    """
    if params.shuffle:
        digest = _digest(key, params.seed)
        _, cut = _cut(df, digest, lambda rows: ceil(rows * params.test_size))
        return df.withColumn(name, F.lit(False) if cut is None else digest <= cut)
    total = df.count()
    train_rows = total - ceil(total * params.test_size)
    # Rows without a time come first.
    order = [F.coalesce(micros(time), F.lit(-(1 << 62))), *(F.col(k).cast("long") for k in key)]
    return df.withColumn(name, ~first_rows(df, order, train_rows))


def split(df: DataFrame, params: TrainingParams, key: Sequence[str], time: str = "time") -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows)."""
    marked = mark_test(df, params, key, time, "_is_test")
    return marked.where("not _is_test").drop("_is_test"), marked.where("_is_test").drop("_is_test")


def rows_to_fit(train: DataFrame, params: TrainingParams, key: Sequence[str], partition_rows: int = 5_000) -> DataFrame:
    """All training rows, or exactly ``params.fit_rows`` of them: those whose digest ranks lowest.

    The chosen rows are dealt by key and ordered, so that the same rows give the same forest.
    """
    if params.fit_rows is None:
        return train
    digest = _digest(key, params.seed)
    rows, cut = _cut(train, digest, lambda _: params.fit_rows)
    if rows <= params.fit_rows:
        return train
    chosen = train.where(digest <= cut)
    return chosen.repartition(-(-params.fit_rows // partition_rows), *key).sortWithinPartitions(*key)
