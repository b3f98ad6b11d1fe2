"""Nearest place within a radius, and regular grids."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerofuse.functions.geo import EARTH_RADIUS_KM, haversine_km, snap_to_grid

PLACE = ("lat", "lon")


def places(df: DataFrame) -> DataFrame:
    """Distinct coordinates; combines map-side, so a busy place costs one row per task."""
    return df.select(*PLACE).where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()


AXES = ("x", "y", "z")
# Cells that hold more distinct places than this are refined before places are compared.
CROWD = 256
# Each refinement cuts a cell in this many parts per axis.
FANOUT = 4
MAX_LEVELS = 12
# Far below any meaningful distance, far above rounding of the positions.
SLACK_KM = 1e-5


def _with_position(df: DataFrame) -> DataFrame:
    """Cartesian position in kilometres. No seam at the date line and no poles to treat apart."""
    flat = F.cos(F.radians("lat")) * EARTH_RADIUS_KM
    return df.select(
        "*",
        (flat * F.cos(F.radians("lon"))).alias("x"),
        (flat * F.sin(F.radians("lon"))).alias("y"),
        (F.sin(F.radians("lat")) * EARTH_RADIUS_KM).alias("z"),
    )


def _chord_km(radius_km: float) -> float:
    """Straight-line length of a great-circle distance, widened against rounding."""
    angle = min(radius_km / EARTH_RADIUS_KM, math.pi)
    return 2 * EARTH_RADIUS_KM * math.sin(angle / 2) + SLACK_KM


def _cell(axis: str, side: float) -> Column:
    return F.floor(F.col(axis) / side).alias(f"_{axis}")


CELL = [f"_{axis}" for axis in AXES]


def _levels_needed(targets: DataFrame, side: float) -> int:
    """How often cells must be cut until none is crowded; one small aggregate per level tried."""
    for level in range(MAX_LEVELS):
        cells = targets.groupBy(*(_cell(a, side / FANOUT**level) for a in AXES)).count()
        if (cells.agg(F.max("count")).first()[0] or 0) <= CROWD:
            return level
    return MAX_LEVELS


def _refine(candidates: DataFrame, targets: DataFrame, side: float, chord: float) -> DataFrame:
    """Replace each candidate cell by its occupied parts that can still hold the nearest place.

    Every occupied part holds a place no farther than its farthest corner, so a part whose nearest
    point lies beyond the smallest such distance is out. Few parts per searching place remain,
    however many places they hold.
    """
    parts = targets.select(*(_cell(a, side) for a in AXES)).distinct()
    inside = [F.floor(F.col(c) / FANOUT).alias(f"{c}_of") for c in CELL]
    parts = parts.select(*(F.col(c).alias(f"{c}_part") for c in CELL), *inside)
    joined = candidates.join(
        parts.withColumnsRenamed({f"{c}_of": c for c in CELL}), CELL
    )
    near, far = F.lit(0.0), F.lit(0.0)
    for axis in AXES:
        low = F.col(f"_{axis}_part") * side
        here = F.col(axis)
        gap = F.greatest(low - here, here - low - side, F.lit(0.0))
        reach = F.greatest(F.abs(here - low), F.abs(low + side - here))
        near, far = near + gap * gap, far + reach * reach
    measured = joined.withColumns({"_near": F.sqrt(near), "_far": F.sqrt(far)}).where(F.col("_near") <= chord)
    bound = F.min("_far").over(Window.partitionBy(*PLACE))
    return measured.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound") + SLACK_KM).select(
        *PLACE, *AXES, *(F.col(f"{c}_part").alias(c) for c in CELL)
    )


def nearest_within(left: DataFrame, right: DataFrame, radius_km: float, prefix: str = "near_",
                   levels: int | None = None) -> DataFrame:
    """For every distinct left place the nearest distinct right place at most ``radius_km`` away.

    Columns: lat, lon, ``<prefix>lat``, ``<prefix>lon``, distance_km. Left places without a hit are
    absent. Equal distances (to a millimetre) go to the smaller (lat, lon).

    Places are put in cubic cells twice as wide as the search sphere; a sphere then touches at most
    two cells per axis, and the candidates come from an equi-join on the cell. Where cells are crowded
    they are cut, and the parts that cannot hold the nearest place are dropped before any places are
    compared. ``levels`` gives the number of cuts; by default it is measured.
    """
    chord = _chord_km(radius_km)
    side = 2 * chord
    targets = _with_position(places(right))
    if levels is None:
        levels = _levels_needed(targets, side)
    candidates = _with_position(places(left))
    for axis in AXES:
        here = F.col(axis)
        touched = F.sequence(F.floor((here - chord) / side), F.floor((here + chord) / side))
        candidates = candidates.withColumn(f"_{axis}", F.explode(touched))
    for level in range(1, levels + 1):
        candidates = _refine(candidates, targets, side / FANOUT**level, chord)

    finest = side / FANOUT**levels
    near = targets.select(
        F.col("lat").alias(f"{prefix}lat"), F.col("lon").alias(f"{prefix}lon"), *(_cell(a, finest) for a in AXES)
    )
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col(f"{prefix}lat"), F.col(f"{prefix}lon"))
    compared = (
        candidates.join(near, CELL).withColumn("distance_km", distance).where(F.col("distance_km") <= radius_km)
    )
    best = F.min(
        F.struct(F.round("distance_km", 6).alias("rank"), f"{prefix}lat", f"{prefix}lon", "distance_km")
    )
    return compared.groupBy(*PLACE).agg(best.alias("best")).select(
        *PLACE, f"best.{prefix}lat", f"best.{prefix}lon", "best.distance_km"
    )


def assign_to_grid(df: DataFrame, *, lat_origin: float, lon_origin: float, step: float, digits: int) -> DataFrame:
    """Replace coordinates by those of the nearest node of a regular grid."""
    return df.withColumns(
        {
            "lat": snap_to_grid(F.col("lat"), lat_origin, step, digits),
            "lon": snap_to_grid(F.col("lon"), lon_origin, step, digits),
        }
    )


def regrid_mean(df: DataFrame, values: Sequence[str], *, lat_origin: float, lon_origin: float, step: float,
                digits: int) -> DataFrame:
    """Mean of observations per grid node and time."""
    snapped = assign_to_grid(df, lat_origin=lat_origin, lon_origin=lon_origin, step=step, digits=digits)
    return snapped.groupBy(*PLACE, "time").agg(*(F.avg(v).alias(v) for v in values), F.count("*").alias("n"))


def grid_skeleton(spark: SparkSession, *, start: datetime, end: datetime, lat_min: float, lat_max: float,
                  lon_min: float, lon_max: float, step: float, digits: int,
                  every: timedelta = timedelta(days=1)) -> DataFrame:
    """Every time x latitude x longitude of a regular grid, ends included.

    Built from one running number, so it is generated in parallel and nothing is crossed.
    """
    n_time = (end - start) // every + 1
    n_lat = int(math.floor((lat_max - lat_min) / step + 1e-9)) + 1
    n_lon = int(math.floor((lon_max - lon_min) / step + 1e-9)) + 1
    number = F.col("id")
    per_day = n_lat * n_lon
    seconds = int(every.total_seconds())
    moment = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.floor(number / per_day) * seconds).cast("decimal(18,6)")
    )
    return spark.range(n_time * per_day).select(
        moment.alias("time"),
        F.round(lat_min + F.floor(F.pmod(number, F.lit(per_day)) / n_lon) * step, digits).alias("lat"),
        F.round(lon_min + F.pmod(number, F.lit(n_lon)) * step, digits).alias("lon"),
    )


def coverage_gaps(skeleton: DataFrame, observed: DataFrame) -> DataFrame:
    """Grid nodes and times for which there is no observation."""
    seen = observed.select("time", *PLACE).distinct()
    return skeleton.join(seen, ["time", *PLACE], "left_anti")


def place_of(df: DataFrame, lookup: DataFrame, on: str, default_lat: float | None = None,
             default_lon: float | None = None) -> DataFrame:
    """Coordinates by name from a lookup table; names it lacks get the default, or NULL."""
    joined = df.join(lookup.select(on, *PLACE), on, "left")
    return joined.withColumns(
        {
            "lat": F.coalesce("lat", F.lit(default_lat).cast("double")),
            "lon": F.coalesce("lon", F.lit(default_lon).cast("double")),
        }
    )
