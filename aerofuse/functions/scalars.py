"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clip(column: Column, low: float, high: float) -> Column:
    """Limit to [low, high]. A missing value stays missing, which greatest/least would not do."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark sorts NaN above every number; missing values are NULL from here on."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *(
            F.when(~F.isnan(name), F.col(name)).alias(name) if name in floats else F.col(name)
            for name in df.columns
        )
    )


def day_of_year(time: Column) -> Column:
    return F.dayofyear(time)


def with_time_features(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumns(
        {
            "day_of_year": F.dayofyear(time),
            "month_of_year": F.month(time),
            "hour_of_day": F.hour(time),
        }
    )


def parse_number(text: Column) -> Column:
    """NULL where the text is not a number."""
    return text.try_cast("double")


def parse_time(text: Column) -> Column:
    """ISO timestamp, with a trailing ``Z`` or an offset, as zone-less UTC; NULL if unreadable."""
    return text.try_cast("timestamp_ltz").cast("timestamp_ntz")


def station_key(city: Column, name: Column, identifier: Column) -> Column:
    """``city-name``; a station without a name goes by its identifier."""
    return F.concat_ws("-", city, F.coalesce(name, identifier.cast("string")))
