"""As-of join: the right row nearest in time, within a tolerance, per key.

Time is cut into slices as long as the tolerance. A right row that may serve a left row is in the
same slice or is the last of the slice before or the first of the slice after, so each slice is
given those two border rows and is then complete on its own. The window that finds the neighbours
runs per (key, slice): a key that holds a third of all rows is spread over its slices, and no pairs
are formed. Both sides are reduced to one row per (key, instant) first, with map-side combining, so
copies never meet in one task. A (key, slice) group thus holds at most one row per side and instant.

Where one key has so many distinct instants within a tolerance that even a slice is too much for one
task, the ``ranges`` layout sweeps range shards instead (see ``ordering``), at the cost of writing the
layout. ``layout="auto"``, the default, measures both sides in one narrow aggregate and chooses.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerofuse.operators.ordering import SO_FAR, range_shards, with_known_neighbours
from aerofuse.session import micros

DIRECTIONS = ("nearest", "backward", "forward")
LAYOUTS = ("slices", "ranges", "auto")
# More instants of one key within a tolerance than this are spread over range shards.
MAX_SLICE_ROWS = 20_000_000


def _slice_of(at: Column, width: int) -> Column:
    return at - F.pmod(at, F.lit(width))


def _slice_sizes(df: DataFrame, by: Sequence[str], tolerance: timedelta, time: str) -> DataFrame:
    width = max(tolerance // timedelta(microseconds=1), 1)
    return df.groupBy(*by, _slice_of(micros(time), width).alias("_slice")).agg(F.count(time).alias("_rows"))


def densest_slice(df: DataFrame, by: Sequence[str], tolerance: timedelta, time: str = "time") -> int:
    """Most rows any key has in one slice; one narrow aggregate. Copies of an instant count each."""
    return _slice_sizes(df, by, tolerance, time).agg(F.max("_rows")).first()[0] or 0


def choose_layout(left: DataFrame, right: DataFrame, by: Sequence[str], tolerance: timedelta, time: str = "time",
                  limit: int = MAX_SLICE_ROWS) -> str:
    """``slices`` where no key has more than ``limit`` distinct instants of a side in a slice, else ``ranges``.

    Rows are counted first, for both sides at once. Only if they are too many in a slice are its distinct
    instants counted, since copies of an instant are combined before the sweep.
    """
    sides = [left.select(*by, time), right.select(*by, time)]
    sizes = [_slice_sizes(side, by, tolerance, time).select("_rows") for side in sides]
    if (sizes[0].unionByName(sizes[1]).agg(F.max("_rows")).first()[0] or 0) <= limit:
        return "slices"
    densest = max(densest_slice(side.distinct(), by, tolerance, time) for side in sides)
    return "slices" if densest <= limit else "ranges"


def _one_per_instant(right: DataFrame, by: Sequence[str], values: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """The first right row in ``order`` (then by value) of every (key, instant)."""
    payload = [*order, *(v for v in values if v not in order)]
    best = F.min(F.struct(*payload)).alias("best")
    return right.groupBy(*by, "_at").agg(best).select(
        *by, F.struct("_at", *(F.col(f"best.{v}").alias(v) for v in values)).alias("r")
    )


def _with_borders(instants: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Every right row in its own slice, plus each slice's border rows in the adjoining slices."""
    own = instants.withColumn("_slice", _slice_of(F.col("r._at"), width))
    borders = own.groupBy(*by, "_slice").agg(F.min("r").alias("first"), F.max("r").alias("last"))
    handed_on = borders.select(
        *by,
        F.inline(
            F.array(
                F.struct((F.col("_slice") + width).alias("_slice"), F.col("last").alias("r")),
                F.struct((F.col("_slice") - width).alias("_slice"), F.col("first").alias("r")),
            )
        ),
    )
    return own.unionByName(handed_on)


def _choose(direction: str, at: Column, tolerance: int) -> Column:
    earlier, later = F.col("_earlier"), F.col("_later")
    earlier_ok = at - F.col("_earlier._at") <= tolerance
    later_ok = F.col("_later._at") - at <= tolerance
    if direction == "backward":
        return F.when(earlier_ok, earlier)
    if direction == "forward":
        return F.when(later_ok, later)
    # On equal distance the earlier row is taken.
    closer_later = later_ok & (
        F.col("_earlier._at").isNull() | (F.col("_later._at") - at < at - F.col("_earlier._at"))
    )
    return F.when(closer_later, later).when(earlier_ok, earlier)


def _sweep_slices(asked: DataFrame, instants: DataFrame, by: Sequence[str], limit: int, direction: str,
                  exact: bool) -> DataFrame:
    """Asked instants with the right rows next to them, found in each slice alone."""
    width = max(limit, 1)
    both = asked.select("*", _slice_of(F.col("_at"), width).alias("_slice"), F.lit(1).alias("_asks")).unionByName(
        _with_borders(instants, by, width).select("*", F.col("r._at").alias("_at"), F.lit(0).alias("_asks")),
        allowMissingColumns=True,
    )
    group = Window.partitionBy(*by, "_slice")
    # Both frames run from the start of the group to the current row, so each is one sweep.
    asks = F.col("_asks").asc() if exact else F.col("_asks").desc()
    found = []
    if direction != "forward":
        upward = group.orderBy(F.col("_at").asc(), asks).rowsBetween(*SO_FAR)
        found.append(F.last("r", True).over(upward).alias("_earlier"))
    if direction != "backward":
        downward = group.orderBy(F.col("_at").desc(), asks).rowsBetween(*SO_FAR)
        found.append(F.last("r", True).over(downward).alias("_later"))
    return both.select("*", *found).where(F.col("_asks") == 1)


def _sweep_ranges(asked: DataFrame, instants: DataFrame, by: Sequence[str], direction: str, exact: bool) -> DataFrame:
    """The same over range shards of (key, instant), whatever a key holds."""
    if direction == "nearest" and not exact:
        raise ValueError("the ranges layout needs exact=True for the nearest row")
    # A right row at the asked instant must lie on the side that is searched, or on the other one.
    right_first = (direction == "forward") != exact
    both = asked.withColumn("_order", F.lit(1 if right_first else 0)).unionByName(
        instants.select("*", F.col("r._at").alias("_at"), F.lit(0 if right_first else 1).alias("_order")),
        allowMissingColumns=True,
    ).withColumn("_asks", F.col("r").isNull()).withColumnRenamed("_at", "_instant")
    swept = with_known_neighbours(range_shards(both, [*by, "_instant", "_order"]), by, {"r": F.col("r")})
    return swept.where("_asks").select(
        *by,
        F.col("_instant").alias("_at"),
        F.col("_before_r.value").alias("_earlier"),
        F.col("_after_r.value").alias("_later"),
    )


def asof_answers(
    left: DataFrame,
    right: DataFrame,
    *,
    values: Sequence[str],
    tolerance: timedelta,
    by: Sequence[str] = (),
    time: str = "time",
    direction: str = "nearest",
    order: Sequence[str] = (),
    exact: bool = True,
    unique_right: bool = False,
    layout: str = "auto",
) -> DataFrame:
    """One row per (key, instant) of ``left`` that has a match: the key, ``_at``, the values and ``_gap``.

    For joins of one left side with several right sides: all answers follow from the left side itself.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {', '.join(DIRECTIONS)}")
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}")
    limit = tolerance // timedelta(microseconds=1)
    if layout == "auto" and direction == "nearest" and not exact:
        layout = "slices"  # the only one that can leave out the row's own instant on both sides
    if layout == "auto":
        layout = choose_layout(left, right, by, tolerance, time, MAX_SLICE_ROWS)

    stamped = right.withColumn("_at", micros(time)).where(F.col("_at").isNotNull())
    if unique_right:
        instants = stamped.select(*by, F.struct("_at", *values).alias("r"))
    else:
        instants = _one_per_instant(stamped, by, values, order)
    asked = left.select(*by, micros(time).alias("_at")).where(F.col("_at").isNotNull()).distinct()
    if layout == "slices":
        swept = _sweep_slices(asked, instants, by, limit, direction, exact)
    else:
        swept = _sweep_ranges(asked, instants, by, direction, exact)

    hit = _choose(direction, F.col("_at"), limit)
    found = swept.select(*by, "_at", hit.alias("_hit")).where(F.col("_hit").isNotNull())
    return found.select(
        *by, "_at", *(F.col(f"_hit.{v}").alias(v) for v in values), (F.col("_hit._at") - F.col("_at")).alias("_gap")
    )


def asof_join(left: DataFrame, right: DataFrame, *, values: Sequence[str], tolerance: timedelta,
              by: Sequence[str] = (), time: str = "time", gap: str | None = None, **options) -> DataFrame:
    """Left outer as-of join; unmatched rows have NULL ``values``.

    Options: ``direction``, nearest (default), backward or forward. ``order`` ranks right rows of one
    key that share an instant. ``exact=False`` leaves out right rows at the very instant of the left
    row. ``unique_right=True`` promises one right row per (key, instant), as in a regular grid, and
    saves the reduction. ``layout``, see above. ``gap`` names a column for the difference right minus
    left in microseconds.
    """
    answers = asof_answers(left, right, values=values, tolerance=tolerance, by=by, time=time, **options)
    # One answer per (key, instant): AQE may split a busy instant of the left side.
    joined = left.withColumn("_at", micros(time)).join(answers, [*by, "_at"], "left")
    extra = [F.col("_gap").alias(gap)] if gap else []
    return joined.select(*left.columns, *values, *extra)
