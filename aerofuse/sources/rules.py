"""Validation: declared predicates evaluated together in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ValidationError(ValueError):
    """The data does not satisfy what the operator requires."""


@dataclass(frozen=True)
class Rule:
    """Inclusive range of a column; a missing value satisfies every range."""

    name: str
    column: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        value = F.col(self.column)
        parts = []
        if self.low is not None:
            parts.append(value < self.low)
        if self.high is not None:
            parts.append(value > self.high)
        condition = parts[0] if len(parts) == 1 else parts[0] | parts[1]
        return F.coalesce(condition, F.lit(False))


# The permitted ranges.
_PLACE = (Rule("lat_range", "lat", -90, 90), Rule("lon_range", "lon", -180, 180))
STATION_RULES = _PLACE
AEROSOL_RULES = (
    *_PLACE,
    Rule("aod_range", "aod", 0, 5),
    Rule("cloud_fraction_range", "cloud_fraction", 0, 1),
)
WEATHER_RULES = (
    Rule("temperature_range", "temperature", 200, 330),
    Rule("humidity_range", "humidity", 0, 100),
    Rule("wind_speed_range", "wind_speed", 0),
    Rule("boundary_layer_height_range", "boundary_layer_height", 0, 3000),
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail with the absent names, in the order asked for. Looks at the schema only."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValidationError(f"The table lacks {', '.join(absent)}")
    return df


def check_schema(df: DataFrame, required: Sequence[str], numeric: Sequence[str] = (),
                 time: str | None = "time") -> DataFrame:
    """Required names, numeric types and timestamp type; reads the schema, runs no job."""
    require_columns(df, required)
    for name in numeric:
        kind = df.schema[name].dataType
        if not isinstance(kind, T.NumericType):
            raise ValidationError(f"{name} holds {kind.simpleString()}, a number is needed")
    if time is not None and not isinstance(
        df.schema[time].dataType, (T.TimestampType, T.TimestampNTZType)
    ):
        raise ValidationError(f"{time} holds no timestamps")
    return df


def violation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: how many rows break it. All rules share one scan and one aggregate."""
    counts = df.agg(*(F.count_if(rule.broken()).alias(rule.name) for rule in rules))
    return counts.unpivot([], [rule.name for rule in rules], "rule", "violations")


def quarantine(df: DataFrame, rules: Sequence[Rule], column: str = "broken_rules") -> DataFrame:
    """Add the names of the broken rules of each row (empty for a sound row)."""
    flags = F.array(*(F.when(rule.broken(), F.lit(rule.name)) for rule in rules))
    return df.withColumn(column, F.array_compact(flags))


def split_sound(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rows set aside with the names of the rules they break)."""
    marked = quarantine(df, rules)
    return (
        marked.where(F.size("broken_rules") == 0).drop("broken_rules"),
        marked.where(F.size("broken_rules") > 0),
    )


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Fail if any row breaks any rule, reporting counts. Runs one aggregate job."""
    broken = violation_report(df, rules).where("violations > 0").collect()
    if broken:
        detail = ", ".join(f"{row['rule']}: {row['violations']} rows" for row in broken)
        raise ValidationError(f"Values outside the permitted range ({detail})")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Opt-in emptiness check; runs a job that stops at the first row."""
    if df.isEmpty():
        raise ValidationError(message)
    return df
