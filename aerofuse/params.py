"""Parameters as plain dataclasses, checked on construction."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

# Model inputs, in the order the model expects them, and its target.
FEATURES = (
    "aod",
    "temperature",
    "humidity",
    "wind_speed",
    "boundary_layer_height",
    "lat",
    "lon",
    "day_of_year",
)
TARGET = "pm25"


@dataclass(frozen=True)
class FusionParams:
    """Radii are inclusive kilometres, tolerances inclusive time differences."""

    aerosol_radius_km: float = 10.0
    aerosol_tolerance: timedelta = timedelta(hours=6)
    weather_radius_km: float = 50.0
    weather_tolerance: timedelta = timedelta(hours=12)

    def __post_init__(self) -> None:
        if self.aerosol_radius_km <= 0 or self.weather_radius_km <= 0:
            raise ValueError("radii must be positive")


@dataclass(frozen=True)
class ForestParams:
    trees: int = 300
    max_depth: int = 16
    min_leaf: int = 2
    max_bins: int = 128
    seed: int = 42


@dataclass(frozen=True)
class TrainingParams:
    features: tuple[str, ...] = FEATURES
    target: str = TARGET
    test_size: float = 0.2
    shuffle: bool = True
    seed: int = 42
    forest: ForestParams = field(default_factory=ForestParams)
    # Most labelled rows the forest is fitted on; None takes all training rows. Scores and errors cover all test rows.
    fit_rows: int | None = None

    def __post_init__(self) -> None:
        if self.fit_rows is not None and self.fit_rows < 1:
            raise ValueError("fit_rows must be positive")
        if not 0 < self.test_size < 1:
            raise ValueError("test_size must lie strictly between 0 and 1")
        if not self.features:
            raise ValueError("at least one feature column is needed")


@dataclass(frozen=True)
class QualityParams:
    drop_missing_target: bool = True
    max_missing_fraction: float = 0.4
    on_exceed: str = "warn"

    def __post_init__(self) -> None:
        if not 0 <= self.max_missing_fraction < 1:
            raise ValueError("max_missing_fraction must lie in [0, 1)")
        if self.on_exceed not in ("warn", "fail"):
            raise ValueError("on_exceed must be 'warn' or 'fail'")
