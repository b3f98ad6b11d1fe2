"""Overwrite fused rows with measured values taken nearby at nearly the same time.

The first target in reach of an observation can be found in two ways, both exact:

* ``places``: list the pairs of observed and target places that are close, then look forward in time
  at each observed place with an as-of join. No row of an observation meets more than one target. This
  suits stations, which have few places and long histories.
* ``moments``: meet rows in cells of place and time. This suits instruments that move, where nearly
  every row has a place of its own and the list of close places would outgrow the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.asof import asof_join
from aerofuse.operators.spatial import PLACE, places
from aerofuse.session import micros

ROUTES = ("places", "moments", "auto")
# Target places in one cell above which rows meet in cells of place and time instead.
MAX_CELL_PLACES = 1000


def _cell(name: str, degrees: float) -> Column:
    # Slightly wider than the limit, so that rounding cannot part neighbours by two cells.
    return F.floor(F.col(name) / (degrees * (1 + 1e-9)))


def _in_cell(df: DataFrame, degrees: float) -> DataFrame:
    return df.select("*", _cell("lat", degrees).alias("_y"), _cell("lon", degrees).alias("_x"))


def _around(df: DataFrame, degrees: float) -> DataFrame:
    """Each row in its own cell and the eight next to it."""
    rows = df.withColumn("_y", F.explode(F.sequence(_cell("lat", degrees) - 1, _cell("lat", degrees) + 1)))
    return rows.withColumn("_x", F.explode(F.sequence(_cell("lon", degrees) - 1, _cell("lon", degrees) + 1)))


def _close(degrees: float) -> Column:
    return (F.abs(F.col("lat") - F.col("_t_lat")) < degrees) & (F.abs(F.col("lon") - F.col("_t_lon")) < degrees)


def close_places(left: DataFrame, right: DataFrame, degrees: float) -> DataFrame:
    """Pairs of distinct places that differ by less than ``degrees`` in both coordinates."""
    near = _in_cell(places(right), degrees).withColumnsRenamed({"lat": "_t_lat", "lon": "_t_lon"})
    return _around(places(left), degrees).join(near, ["_y", "_x"]).where(_close(degrees)).drop("_y", "_x")


def places_in_largest_cell(sites: DataFrame, degrees: float) -> int:
    """An observed place meets the places of nine cells, so it has at most nine times as many close ones."""
    cells = _in_cell(places(sites), degrees).groupBy("_y", "_x").count()
    return cells.agg(F.max("count")).first()[0] or 0


def _found_by_place(observations: DataFrame, firsts: DataFrame, sites: DataFrame, within: timedelta,
                    degrees: float) -> DataFrame:
    """As targets are ordered by time, the first in reach is the first after the lower time limit."""
    pairs = close_places(observations, sites, degrees)
    reachable = firsts.withColumnsRenamed({"lat": "_t_lat", "lon": "_t_lon"}).join(pairs, ["_t_lat", "_t_lon"])
    asking = observations.withColumn("time", F.col("time") - within)
    return asof_join(
        asking,
        reachable.select(*PLACE, "time", "_target"),
        values=("_target",),
        by=PLACE,
        order=("_target",),
        tolerance=2 * within - timedelta(microseconds=1),
        layout="slices", direction="forward",
        exact=False,
    )


def _found_by_moment(observations: DataFrame, firsts: DataFrame, within: timedelta, degrees: float) -> DataFrame:
    """Rows meet per cell of place and time; only the first target per (place, instant) is kept."""
    span = within // timedelta(microseconds=1)

    def slot(at: Column) -> Column:
        return F.call_function("div", at - F.pmod(at, F.lit(2 * span)), F.lit(2 * span))

    near = _in_cell(firsts, degrees).select(
        "_y", "_x", F.col("lat").alias("_t_lat"), F.col("lon").alias("_t_lon"), micros("time").alias("_t_at"), "_target"
    ).withColumn("_slot", slot(F.col("_t_at")))
    keyed = observations.withColumn("_at", micros("time"))
    asked = keyed.select(*PLACE, "_at").dropna().distinct()
    asked = asked.withColumn("_slot", F.explode(F.sequence(slot(F.col("_at") - span), slot(F.col("_at") + span))))
    met = (
        _around(asked, degrees)
        .join(near, ["_y", "_x", "_slot"])
        .where(_close(degrees) & (F.abs(F.col("_at") - F.col("_t_at")) < span))
    )
    first = met.groupBy(*PLACE, "_at").agg(F.min(F.struct("_t_at", "_target")).alias("first"))
    answers = first.select(*PLACE, "_at", F.col("first._target").alias("_target"))
    return keyed.join(answers, [*PLACE, "_at"], "left").drop("_at")


def match_update(
    targets: DataFrame,
    observations: DataFrame,
    *,
    target_key: str,
    observation_order: Sequence[str],
    within: timedelta = timedelta(hours=1),
    degrees: float = 0.1,
    route: str = "auto",
    sites: DataFrame | None = None,
) -> DataFrame:
    """Each observation overwrites the first target within the (open) limits of time and place.

    Targets are ordered by (time, ``target_key``), observations by ``observation_order``; a later
    observation overrides an earlier one, and a missing pm10 leaves the target's value alone.
    ``sites`` may name a table with all places of the targets, when those would be dear to derive.
    """
    sites = targets if sites is None else sites
    if route not in ROUTES:
        raise ValueError(f"route must be one of {', '.join(ROUTES)}")
    if route == "auto":
        crowded = places_in_largest_cell(sites, degrees) > MAX_CELL_PLACES
        route = "moments" if crowded else "places"
    # One row per (place, instant), combined map-side.
    firsts = targets.groupBy(*PLACE, "time").agg(F.min(target_key).alias("_target"))
    if route == "places":
        found = _found_by_place(observations, firsts, sites, within, degrees)
    else:
        found = _found_by_moment(observations, firsts, within, degrees)
    found = found.where(F.col("_target").isNotNull())

    order = F.struct(*observation_order)
    newest = found.groupBy("_target").agg(
        F.max_by(F.struct(F.col("pm25").alias("value")), order).alias("_pm25"),
        F.max_by("pm10", F.when(F.col("pm10").isNotNull(), order)).alias("_pm10"),
    )
    updated = targets.join(newest.withColumnRenamed("_target", target_key), target_key, "left")
    return updated.withColumns(
        {
            "pm25": F.when(F.col("_pm25").isNotNull(), F.col("_pm25.value")).otherwise(F.col("pm25")),
            "pm10": F.coalesce("_pm10", "pm10"),
        }
    ).select(*targets.columns)
