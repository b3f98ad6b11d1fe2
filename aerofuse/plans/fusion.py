"""Fusion of station observations with the aerosol and the weather grid."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.asof import asof_answers
from aerofuse.operators.spatial import PLACE, nearest_within, places
from aerofuse.params import FusionParams
from aerofuse.session import broadcast_if_small, materialize, materialize_counted, micros
from aerofuse.sources.readers import between_dates, only_stations
from aerofuse.sources.rules import (
    AEROSOL_RULES,
    STATION_RULES,
    WEATHER_RULES,
    Rule,
    ValidationError,
    enforce,
    split_sound,
    violation_report,
)

AEROSOL_VALUES = ("aod", "cloud_fraction")
WEATHER_VALUES = ("temperature", "humidity", "wind_speed", "boundary_layer_height")
ON_INVALID = ("ignore", "report", "split", "fail")
# Stands for the missing time of an observation, so that it still meets its place.
NO_TIME = -(1 << 63)


@dataclass(frozen=True)
class Grid:
    """A gridded product and how it is matched. ``order`` ranks rows of one cell and instant;
    ``unique`` promises that there is only one."""

    rows: DataFrame
    values: Sequence[str]
    radius_km: float
    tolerance: timedelta
    order: Sequence[str] = ()
    unique: bool = False


@dataclass(frozen=True)
class SiteMap:
    """The nearest grid cell of every site, written once, with its number of rows."""

    rows: DataFrame
    count: int


def map_sites(sites: DataFrame, grid: Grid, prefix: str, levels: int | None = None) -> SiteMap:
    """One row per distinct site with a cell in the radius.

    It is written because the observations, the grid and the size check all read it. The grid's
    distinct cells are kept while the search measures and uses them, so the grid is scanned once.
    """
    cells = places(grid.rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        nearest = nearest_within(sites, cells, grid.radius_km, prefix, levels)
        return SiteMap(*materialize_counted(nearest.withColumnRenamed("distance_km", f"{prefix}km"), "sites"))
    finally:
        cells.unpersist()


def attach_grids(observations: DataFrame, grids: Sequence[Grid], *, layout: str = "auto",
                 levels: int | None = None) -> DataFrame:
    """Give every observation the values of each grid's nearest cell at the nearest time.

    Observations without a cell in the radius of some grid are dropped; those without a value in the
    tolerance keep NULL. ``layout`` is passed on to the as-of join and ``levels`` to the search for
    the nearest cell.

    The site maps follow from the observations' distinct places, which are gathered once, and are made
    side by side. Everything else is found for the distinct places and times only: their cells, which are
    written once since every grid reads them, then the answers of each grid, none of which waits for
    another. The observations themselves are shuffled once, to meet the finished answers.
    """
    prefixes = [f"_cell{i}_" for i in range(len(grids))]
    sites = places(observations).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(len(grids)) as pool:
            maps = list(pool.map(lambda grid, prefix: map_sites(sites, grid, prefix, levels), grids, prefixes))
    finally:
        sites.unpersist()

    moment = F.coalesce(micros("time"), F.lit(NO_TIME)).alias("_at")
    located = observations.select(*PLACE, "time", moment).distinct()
    for site_map in maps:
        located = located.join(broadcast_if_small(site_map.rows, site_map.count), list(PLACE))
    located = materialize(located, "moments")

    def answers_of(grid: Grid, prefix: str, site_map: SiteMap) -> DataFrame:
        cell = [f"{prefix}lat", f"{prefix}lon"]
        # Only the cells that some site uses take part in the shuffles that follow.
        used = broadcast_if_small(site_map.rows.select(*cell).distinct(), site_map.count)
        nearby = grid.rows.withColumnsRenamed(dict(zip(PLACE, cell, strict=True))).join(used, cell, "left_semi")
        return asof_answers(
            located, nearby, values=grid.values, tolerance=grid.tolerance, by=cell, order=grid.order,
            unique_right=grid.unique, layout=layout,
        ).drop("_gap")

    # Side by side, as each measures its grid before it chooses a layout.
    with ThreadPoolExecutor(len(grids)) as pool:
        answers = list(pool.map(answers_of, grids, prefixes, maps))
    answered = located.drop("time")
    for prefix, answer in zip(prefixes, answers, strict=True):
        answered = answered.join(answer, [f"{prefix}lat", f"{prefix}lon", "_at"], "left")
    values = [v for grid in grids for v in grid.values]
    met = observations.withColumn("_at", moment).join(answered.select(*PLACE, "_at", *values), [*PLACE, "_at"])
    return met.select(*observations.columns, *values)


def aerosol_grid(rows: DataFrame, params: FusionParams = FusionParams(), order: Sequence[str] = (),
                 unique: bool = False) -> Grid:
    return Grid(rows, AEROSOL_VALUES, params.aerosol_radius_km, params.aerosol_tolerance, order, unique)


def weather_grid(rows: DataFrame, params: FusionParams = FusionParams(), order: Sequence[str] = (),
                 unique: bool = False) -> Grid:
    return Grid(rows, WEATHER_VALUES, params.weather_radius_km, params.weather_tolerance, order, unique)


def fuse_aerosol(observations: DataFrame, aerosol: DataFrame, params: FusionParams = FusionParams(), *,
                 order: Sequence[str] = (), unique: bool = False, **options) -> DataFrame:
    return attach_grids(observations, [aerosol_grid(aerosol, params, order, unique)], **options)


def fuse_weather(observations: DataFrame, weather: DataFrame, params: FusionParams = FusionParams(), *,
                 order: Sequence[str] = (), unique: bool = False, **options) -> DataFrame:
    return attach_grids(observations, [weather_grid(weather, params, order, unique)], **options)


def fuse(
    observations: DataFrame,
    aerosol: DataFrame,
    weather: DataFrame,
    params: FusionParams = FusionParams(),
    *,
    aerosol_order: Sequence[str] = (),
    weather_order: Sequence[str] = (),
    unique_grids: bool = False,
    **options,
) -> DataFrame:
    """All three sources."""
    grids = [
        aerosol_grid(aerosol, params, aerosol_order, unique_grids),
        weather_grid(weather, params, weather_order, unique_grids),
    ]
    return attach_grids(observations, grids, **options)


def validated(df: DataFrame, rules: Sequence[Rule], on_invalid: str, rejected: str | None = None,
              name: str = "input") -> DataFrame:
    """Apply the declared rules to a source before it is used.

    ``fail`` stops at any broken rule, ``report`` warns with the counts and keeps all rows (one aggregate
    each), ``split`` writes the rows that break a rule, with the names of the rules, to a folder ``name``
    in ``rejected`` and goes on with the others, ``ignore`` does nothing.
    """
    if on_invalid not in ON_INVALID:
        raise ValueError(f"on_invalid must be one of {', '.join(ON_INVALID)}")
    if on_invalid == "fail":
        return enforce(df, rules)
    if on_invalid == "report":
        broken = violation_report(df, rules).where("violations > 0").collect()
        if broken:
            counts = ", ".join(f"{r['rule']} {r['violations']}" for r in broken)
            warnings.warn(f"{name}: rows outside the permitted ranges: {counts}", stacklevel=2)
    if on_invalid == "split":
        if rejected is None:
            raise ValueError("on_invalid='split' needs a folder for the rejected rows")
        sound, broken_rows = split_sound(df, rules)
        broken_rows.write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/{name}")
        return sound
    return df


def fuse_period(observations: DataFrame, aerosol: DataFrame, weather: DataFrame, start, end,
                stations: Sequence[str] | None = None, params: FusionParams = FusionParams(),
                fail_on_empty: bool = False, on_invalid: str = "fail", rejected: str | None = None,
                **orders) -> DataFrame:
    """Fusion over a period and a choice of stations, each source cut to the period in its scan.

    What remains of each source is validated as ``on_invalid`` says, see ``validated``.
    """
    chosen = only_stations(between_dates(observations, start, end), stations)
    air, met = between_dates(aerosol, start, end), between_dates(weather, start, end)
    chosen = validated(chosen, STATION_RULES, on_invalid, rejected, "stations")
    air = validated(air, AEROSOL_RULES, on_invalid, rejected, "aerosol")
    met = validated(met, WEATHER_RULES, on_invalid, rejected, "weather")
    if fail_on_empty:
        for name, frame in (("station", chosen), ("aerosol", air), ("weather", met)):
            if frame.isEmpty():
                raise ValidationError(f"The {name} data is empty")
    fused = fuse(chosen, air, met, params, **orders)
    if fail_on_empty and fused.isEmpty():
        raise ValidationError("No grid cell in the radius of any station")
    return fused
