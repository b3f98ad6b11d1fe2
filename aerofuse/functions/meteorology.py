"""Weather derivations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerofuse.functions.scalars import clip

# Fixed values of the saturation pressure formula and of the humidity conversion.
MAGNUS_A = 17.27
MAGNUS_B = 237.7
SATURATION_AT_ZERO_HPA = 6.112
EULER = 2.718281828
SURFACE_PRESSURE_HPA = 1013.25
MOLAR_MASS_RATIO = 0.622
ZERO_CELSIUS_K = 273.15

# Months of the named seasons.
SUMMER_MONTHS = (5, 6)
MONSOON_MONTHS = (7, 8, 9)
WINTER_MONTHS = (11, 12, 1, 2)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def relative_humidity(specific_humidity: Column, temperature_k: Column) -> Column:
    """Per cent relative humidity from specific humidity (kg/kg) and temperature (K)."""
    celsius = temperature_k - F.lit(ZERO_CELSIUS_K)
    exponent = F.lit(MAGNUS_A) * celsius / (F.lit(MAGNUS_B) + celsius)
    saturation = F.lit(SATURATION_AT_ZERO_HPA) * F.pow(F.lit(EULER), exponent)
    vapour = specific_humidity * F.lit(SURFACE_PRESSURE_HPA) / F.lit(MOLAR_MASS_RATIO)
    return clip(vapour / saturation * 100, 0.0, 100.0)


def season(time: Column) -> Column:
    month = F.month(time)
    return (
        F.when(month.isin(*SUMMER_MONTHS), "summer")
        .when(month.isin(*MONSOON_MONTHS), "monsoon")
        .when(month.isin(*WINTER_MONTHS), "winter")
        .when(month.isNotNull(), "other")
    )
