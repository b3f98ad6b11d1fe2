"""Air-quality bands, index and advice for a PM2.5 concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.session import small_table

# Upper bound of the band (None = open), index at its lower end, lower bound,
# width, category, colour class and advice.
BANDS = (
    (12, 0, 0, 12, "🟢 GOOD", "good",
     "Air quality is satisfactory. Enjoy your outdoor activities!"),
    (35, 50, 12, 23, "🟡 MODERATE", "moderate",
     "Sensitive individuals should reduce prolonged outdoor exertion."),
    (55, 100, 35, 20, "🟠 UNHEALTHY FOR SENSITIVE GROUPS", "unhealthy",
     "Members of sensitive groups should avoid outdoor activities."),
    (150, 150, 55, 95, "🔴 UNHEALTHY", "very_unhealthy",
     "Everyone should avoid outdoor activities."),
    (None, 500, 150, None, "🟣 HAZARDOUS", "hazardous",
     "Everyone should avoid ALL outdoor exertion."),
)
# Reference concentration and the 24-hour and annual limits.
REFERENCE_PM25 = 25.0
DAILY_LIMIT = 60.0
ANNUAL_LIMIT = 40.0


def _by_band(pm25: Column, results: list[Column]) -> Column:
    chain = None
    for (upper, *_), result in zip(BANDS, results, strict=True):
        condition = pm25.isNotNull() if upper is None else pm25 <= upper
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    return chain


def aqi_category(pm25: Column) -> Column:
    return _by_band(pm25, [F.lit(band[4]) for band in BANDS])


def aqi_index(pm25: Column) -> Column:
    """Index interpolated inside the band and truncated toward zero."""
    levels = []
    for _, base, lower, width, *_ in BANDS:
        if width is None:
            levels.append(F.lit(base))
        elif base == 0:
            levels.append((pm25 / width * 50).cast("int"))
        else:
            levels.append((base + (pm25 - lower) / width * 50).cast("int"))
    return _by_band(pm25, levels)


def delta_to_reference(pm25: Column) -> Column:
    return pm25 - F.lit(REFERENCE_PM25)


def advice_table(spark: SparkSession) -> DataFrame:
    """Five-row lookup: category, colour class, advice."""
    return small_table(spark, [band[4:] for band in BANDS], "category string, color string, advice string")
