"""Exact order-dependent results without a single-task sort or window.

Two tools:

* ``range_shards`` lays rows out in contiguous ranges of a total order. The ranges come from
  Spark's own sampling, so a key that holds a third of all rows is spread over a third of the
  shards. What crosses shard borders is then a frame of at most a few rows per shard.
* ``cut_at_rank`` finds the row at a given rank by narrowing a histogram. It moves counts, not
  rows: every pass is one partial aggregate that returns at most ``BINS`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse.session import broadcast_if_small, materialize

SHARD = "_shard"
INDEX = "_index"
SO_FAR = (Window.unboundedPreceding, Window.currentRow)
BINS = 4096
# A search stops narrowing when so few rows are left that they can be looked at directly.
FEW = 10_000
# A sketched rank is off by at most one in so many.
ACCURACY = 10_000
# Rows meant for one range, so that a task that sweeps some of them keeps to some hundred megabytes at any size of input.
SHARD_ROWS = 100_000


def range_shards(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Rows with their shard number and their index inside the shard, in a total order.

    ``order_by`` must identify a row. The layout is written once, since a second evaluation
    could sample other bounds and so give a row another shard.

    Beyond one range's rows their number follows from the counted rows, since AQE would merge ranges by their bytes
    on disk, which say little of the memory that a sweep over them takes.
    """
    row_id = F.monotonically_increasing_id()
    ranges = -(-df.count() // SHARD_ROWS)
    laid = (
        df.repartitionByRange(*([ranges] if ranges > 1 else []), *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(INDEX, row_id)
    )
    # The upper 31 bits of the generated id are the partition, the lower 33 the row within it.
    return materialize(laid, "ranges").withColumns(
        {
            SHARD: F.shiftright(INDEX, 33).cast("int"),
            INDEX: F.col(INDEX).bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def count_shards(laid: DataFrame) -> int:
    """Shards of a layout that hold rows, which bounds the tables of one row per shard. Reads one column."""
    return laid.select(SHARD).distinct().count()


def with_position(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
                  name: str = "position") -> DataFrame:
    """1-based rank of every row in a total order, per key or over the whole table."""
    laid = range_shards(df, [*partition_by, *order_by])
    sizes = laid.groupBy(*partition_by, SHARD).agg(
        F.count("*").alias("_size"), F.min(INDEX).alias("_start")
    )
    earlier = (
        Window.partitionBy(*partition_by)
        .orderBy(SHARD)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    if not partition_by:
        # One row per shard.
        placed = laid.join(broadcast_if_small(offsets.select(SHARD, "_before"), count_shards(laid)), SHARD)
        return placed.withColumn(name, F.col(INDEX) + F.col("_before") + 1).drop(SHARD, INDEX, "_before")
    # One row per (key, shard); equal to the number of keys plus at most one per shard.
    keys = [*partition_by, SHARD]
    placed = laid.join(offsets.select(*keys, "_start", "_before"), keys)
    return placed.withColumn(
        name, F.col(INDEX) - F.col("_start") + F.col("_before") + 1
    ).drop(SHARD, INDEX, "_start", "_before")


def with_known_neighbours(laid: DataFrame, partition_by: Sequence[str], known: dict[str, Column]) -> DataFrame:
    """For every row of a range layout, the nearest known values before and after it in its key.

    ``known`` maps a name to a column that is NULL where nothing is known. Added columns: ``_at``, the
    index of the row in the whole order, and ``_before_<name>`` and ``_after_<name>``, structs of
    ``at`` and ``value``, both of which include the row itself.

    Each (key, shard) group is swept alone, in twice as many tasks as there are shards, so a task meets few of them however
    many there are in all. What a group needs from elsewhere comes from a table with
    one row per group; only the first and the last group of a shard can need it, so it holds at most two
    rows per shard. It is broadcast if the counted shards permit it.
    """
    shards = count_shards(laid)
    # One row per shard.
    sizes = laid.groupBy(SHARD).agg(F.count("*").alias("_size"))
    earlier_shards = Window.orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(SHARD, F.coalesce(F.sum("_size").over(earlier_shards), F.lit(0)).alias("_start"))
    points = {
        name: F.when(value.isNotNull(), F.struct(F.col("_at").alias("at"), value.alias("value")))
        for name, value in known.items()
    }
    rows = laid.join(broadcast_if_small(starts, shards), SHARD).withColumn("_at", F.col(INDEX) + F.col("_start")).drop("_start", INDEX)

    keys = [*partition_by, SHARD]
    ends = []
    for n, value in known.items():
        at = F.when(value.isNotNull(), F.col("_at"))
        # Position and value apart: numbers aggregate by hashing, structs would be sorted first.
        ends += [
            F.min(at).alias(f"_first_at_{n}"), F.min_by(value, at).alias(f"_first_{n}"),
            F.max(at).alias(f"_last_at_{n}"), F.max_by(value, at).alias(f"_last_{n}"),
        ]
    groups = rows.groupBy(*keys).agg(*ends)

    def end(side: str, name: str) -> Column:
        at = F.col(f"_{side}_at_{name}")
        return F.when(at.isNotNull(), F.struct(at.alias("at"), F.col(f"_{side}_{name}").alias("value")))

    others = (Window.unboundedPreceding, -1)
    upward = Window.partitionBy(*partition_by).orderBy(F.col(SHARD).asc()).rowsBetween(*others)
    downward = Window.partitionBy(*partition_by).orderBy(F.col(SHARD).desc()).rowsBetween(*others)
    handed = groups.select(
        *(F.col(k).alias(f"_g_{k}") for k in keys),
        *(F.last(end("last", n), True).over(upward).alias(f"_in_{n}") for n in known),
        *(F.last(end("first", n), True).over(downward).alias(f"_out_{n}") for n in known),
    ).where(reduce(or_, (F.col(f"_{side}_{n}").isNotNull() for side in ("in", "out") for n in known)))
    same_group = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys))
    met = rows.join(broadcast_if_small(handed, 2 * shards), same_group, "left")
    if shards > 1:
        met = met.repartition(2 * shards, *keys)

    group = Window.partitionBy(*keys)
    # Both frames end at the current row, so each is one sweep.
    up, down = (group.orderBy(o).rowsBetween(*SO_FAR) for o in (F.col("_at").asc(), F.col("_at").desc()))
    return met.select(
        *rows.columns,
        *(F.coalesce(F.last(p, True).over(up), F.col(f"_in_{n}")).alias(f"_before_{n}") for n, p in points.items()),
        *(F.coalesce(F.last(p, True).over(down), F.col(f"_out_{n}")).alias(f"_after_{n}") for n, p in points.items()),
    )


@dataclass(frozen=True)
class _Bracket:
    """Values [low, high] that hold the wanted rank, their rows, and how many rows lie below ``low``."""

    low: float
    high: float
    rows: int
    below: int

    @property
    def settled(self) -> bool:
        return self.low == self.high

    def narrowed(self, bins: list, rank: int) -> _Bracket:
        """The bin that holds the rank.

        Its bounds are the smallest and largest value present in it, so the lowest and the highest
        value of a bracket always part and the search ends.
        """
        below = self.below
        for row in sorted(bins, key=lambda r: r["bin"]):
            if rank < below + row["n"]:
                return _Bracket(row["low"], row["high"], row["n"], below)
            below += row["n"]
        raise ValueError(f"rank {rank} is beyond the {below} values present")


def _bin(value: Column, bracket: _Bracket, integral: bool) -> Column:
    if integral:
        width = (bracket.high - bracket.low) // BINS + 1
        return F.call_function("div", value - F.lit(bracket.low), F.lit(width)).cast("int")
    low, high = bracket.low, bracket.high
    if math.isinf(high - low):  # finite ends too far apart for a double
        value, low, high = value / 2, low / 2, high / 2
    return F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1)).cast("int")


def _inside(df: DataFrame, searches: Sequence[tuple[int, str, _Bracket]], integral: bool) -> DataFrame:
    """(search, bin, value) for every search and every row inside its bracket."""
    entries = []
    for i, column, bracket in searches:
        value = F.col(column)
        entry = F.struct(
            F.lit(i).alias("search"), _bin(value, bracket, integral).alias("bin"), value.alias("value")
        )
        entries.append(F.when(value.between(bracket.low, bracket.high), entry))
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _brackets(df: DataFrame, wanted: Sequence[tuple[str, int]], few: int,
              start: Sequence[_Bracket | None] | None = None) -> list[_Bracket]:
    """A bracket for each (column, 0-based rank among the non-NULL values): a single value, or at
    most ``few`` rows. All searches share each pass, which returns at most ``BINS`` rows for each. ``start``
    gives brackets to begin with, where they are known.
    """
    columns = sorted({column for column, _ in wanted})
    integral = isinstance(df.schema[columns[0]].dataType, T.IntegralType)
    ends = df.agg(
        *(f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max, F.count))
    ).first()
    if any(ends[f"count_{c}"] == 0 for c in columns):
        raise ValueError("a column holds no value")
    found = [(start[k] if start else None) or _Bracket(ends[f"min_{c}"], ends[f"max_{c}"], ends[f"count_{c}"], 0)
             for k, (c, _) in enumerate(wanted)]
    while pending := [i for i, b in enumerate(found) if not b.settled and b.rows > few]:
        bins = (
            _inside(df, [(i, wanted[i][0], found[i]) for i in pending], integral)
            .groupBy("search", "bin")
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        for i in pending:
            narrowed = found[i].narrowed([r for r in bins if r["search"] == i], wanted[i][1])
            if narrowed.rows >= found[i].rows:
                raise ArithmeticError(f"the search in {wanted[i][0]} does not narrow: {narrowed}")
            found[i] = narrowed
    return found


def values_at_ranks(df: DataFrame, wanted: Sequence[tuple[str, int]], few: int = FEW,
                    start: Sequence[_Bracket | None] | None = None) -> list[float]:
    """The value at each (column, 0-based rank). The columns must all be integral or all floating."""
    found = _brackets(df, wanted, few, start)
    integral = isinstance(df.schema[wanted[0][0]].dataType, T.IntegralType)
    open_searches = [(i, wanted[i][0], b) for i, b in enumerate(found) if not b.settled]
    rest: dict[int, list] = {i: [] for i, _, _ in open_searches}
    if open_searches:
        # At most ``few`` rows for each search.
        for row in _inside(df, open_searches, integral).collect():
            rest[row["search"]].append(row["value"])
    return [
        sorted(rest[i])[rank - found[i].below] if i in rest else found[i].low
        for i, (_, rank) in enumerate(wanted)
    ]


def cut_at_rank(df: DataFrame, columns: Sequence[str], rank: int, few: int = FEW) -> list[float]:
    """Values of the row at 0-based ``rank`` in the lexicographic order of numeric columns."""
    cut: list[float] = []
    for depth, column in enumerate(columns):
        [bracket] = _brackets(df, [(column, rank)], few)
        df = df.where(F.col(column).between(bracket.low, bracket.high))
        rank -= bracket.below
        if bracket.rows <= few:
            # At most ``few`` rows are left.
            remaining = sorted(tuple(row) for row in df.select(*columns[depth:]).collect())
            return [*cut, *remaining[rank]]
        cut.append(bracket.low)
    return cut


def at_or_before(columns: Sequence[Column], cut: Sequence[float]) -> Column:
    """Whether a row sorts at or before the cut row."""
    condition = columns[-1] <= cut[-1]
    for column, value in reversed(list(zip(columns[:-1], cut[:-1], strict=True))):
        condition = (column < value) | ((column == value) & condition)
    return condition


def first_rows(df: DataFrame, order: Sequence[Column], rows: int) -> Column:
    """Condition that holds for exactly the first ``rows`` rows of an order that identifies rows."""
    if rows == 0:
        return F.lit(False)
    names = [f"_k{i}" for i in range(len(order))]
    keys = df.select(*(c.alias(n) for c, n in zip(order, names, strict=True)))
    return at_or_before(order, cut_at_rank(keys, names, rows - 1))


def _middle_sketch(value: Column) -> Column:
    """Two values that enclose the median: ranks are off by at most one in ACCURACY, the bounds stand two apart."""
    return F.percentile_approx(value, [0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY], ACCURACY)


def exact_medians(df: DataFrame, columns: Sequence[str], sketch: Callable[[Column], Column] = _middle_sketch,
                  few: int = FEW) -> dict[str, float | None]:
    """Exact median of several columns, NULL and NaN ignored; ``None`` for a column without values.

    A first pass counts and sketches all columns; a second one counts what lies below and at the sketched bounds and lists
    the values between them. Where those would be more than ``few``, and where the sketch errs, the search goes on by
    histograms from the bracket that holds the rank. Infinite values are counted and stand at the ends.
    """
    typed = df.select(*(_number(F.col(c).cast("double")).alias(c) for c in columns))
    infinite = F.lit(float("inf"))
    finite = typed.select(*(F.when(F.abs(F.col(c)) < infinite, F.col(c)).alias(c) for c in columns))
    first = typed.agg(*(
        x.alias(f"{name}_{c}") for c in columns for name, x in (
            ("low", F.count_if(F.col(c) == -infinite)), ("high", F.count_if(F.col(c) == infinite)),
            ("mid", F.count_if(F.abs(F.col(c)) < infinite)), ("ends", sketch(F.when(F.abs(F.col(c)) < infinite, F.col(c))))))).first()
    ranks: dict[str, list[int]] = {}  # of the one or two middle values, among all values
    for c in columns:
        total = sum(first[f"{name}_{c}"] for name in ("low", "mid", "high"))
        ranks[c] = sorted({(total - 1) // 2, total // 2}) if total else []
    some = [c for c in columns if ranks[c] and first[f"mid_{c}"]]
    listed = {c: first[f"mid_{c}"] * 6 <= few * ACCURACY for c in some}
    second = finite.agg(F.count(F.lit(1)).alias("rows"), *(
        x.alias(f"{name}_{c}") for c in some for lo, hi in [map(F.lit, first[f"ends_{c}"])] for name, x in (
            ("below", F.count_if(F.col(c) < lo)), ("lo", F.count_if(F.col(c) == lo)),
            ("between", F.count_if((F.col(c) > lo) & (F.col(c) < hi))), ("hi", F.count_if((F.col(c) == hi) & (hi > lo))),
            ("values", F.collect_list(F.when((F.col(c) > lo) & (F.col(c) < hi), F.col(c)) if listed[c] else F.lit(None).cast("double")))
        ))).first() if some else None
    found: dict[str, list[float | None]] = {}
    open_, start = [], []
    for c in columns:
        found[c] = []
        low, mid = first[f"low_{c}"], first[f"mid_{c}"]
        for rank in ranks[c]:
            if not low <= rank < low + mid:
                found[c].append(-math.inf if rank < low else math.inf)
                continue
            (lo, hi), at = first[f"ends_{c}"], rank - low
            below, n_lo, n, n_hi = (second[f"{name}_{c}"] for name in ("below", "lo", "between", "hi"))
            if below <= at < below + n_lo:
                found[c].append(lo)
            elif below + n_lo <= at < below + n_lo + n and len(second[f"values_{c}"]) == n:
                found[c].append(sorted(second[f"values_{c}"])[at - below - n_lo])
            elif below + n_lo + n <= at < below + n_lo + n + n_hi:
                found[c].append(hi)
            else:
                inside = below <= at < below + n_lo + n + n_hi
                found[c].append(None)
                open_.append((c, at))
                start.append(_Bracket(lo, hi, n_lo + n + n_hi, below) if inside else None)
    rest = iter(values_at_ranks(finite, open_, few, start) if open_ else [])
    return {c: _middle([next(rest) if v is None else v for v in found[c]]) if found[c] else None for c in columns}


def _number(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _middle(values: list[float]) -> float:
    total = values[0] + values[-1]
    return total / 2 if math.isfinite(total) or not all(map(math.isfinite, values)) else values[0] / 2 + values[-1] / 2
