"""Preparation of the training table, and the load that updates it with measured values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.interpolate import impute, measure_gaps
from aerofuse.operators.quality import drop_missing_target, report_missing
from aerofuse.operators.reshape import latest_measurements
from aerofuse.operators.update import match_update
from aerofuse.params import FusionParams, QualityParams, TrainingParams
from aerofuse.plans.fusion import fuse
from aerofuse.session import materialize
from aerofuse.sources.readers import require_columns
from aerofuse.sources.rules import require_rows

# The wider radii used when measured values are loaded.
LOAD_PARAMS = FusionParams(aerosol_radius_km=50.0, weather_radius_km=150.0)


def preprocess(
    df: DataFrame,
    training: TrainingParams = TrainingParams(),
    quality: QualityParams = QualityParams(),
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    report: bool = True,
    fail_on_empty: bool = False,
) -> DataFrame:
    """Derive the day of year, check columns, drop rows without target, fill gaps.

    The share of missing values is judged before filling, from the counts that filling takes anyway;
    ``report=False`` leaves that out.
    """
    ready = df
    if "time" in df.columns and "day_of_year" in training.features:
        ready = ready.withColumn("day_of_year", F.dayofyear("time"))
    require_columns(ready, [*training.features, training.target])
    if quality.drop_missing_target:
        ready = drop_missing_target(ready, training.target)
    gaps = measure_gaps(ready, training.features, partition_by)
    if report:
        report_missing(gaps.above(quality.max_missing_fraction), quality.max_missing_fraction, quality.on_exceed)
    filled = impute(ready, training.features, order_by=order_by, partition_by=partition_by, gaps=gaps)
    if fail_on_empty:
        require_rows(filled, "No row is left after preparation.")
    return filled


def load_measured(
    measurements: DataFrame,
    station_rows: DataFrame,
    aerosol: DataFrame,
    weather: DataFrame,
    *,
    row_key: str,
    measurement_key: str,
    params: FusionParams = LOAD_PARAMS,
    **orders,
) -> DataFrame:
    """Fuse the station rows with both grids, then overwrite them with measured values nearby.

    The fused rows are written once, since the search for targets and the update both read them.
    """
    wide = latest_measurements(measurements, measurement_key)
    fused = materialize(fuse(station_rows, aerosol, weather, params, **orders), "fused")
    order = (measurement_key, f"pm10_{measurement_key}")
    updated = match_update(fused, wide, target_key=row_key, observation_order=order, sites=station_rows)
    return updated.withColumn("day_of_year", F.dayofyear("time"))
