"""Missing values and outliers."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.ordering import exact_medians
from aerofuse.session import small_table
from aerofuse.sources.rules import ValidationError


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def dropped_rows(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count_if(F.col(target).isNull()).alias("dropped_rows"), F.count("*").alias("rows"))


def outlier_filter(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Drop values above the limit; missing values stay."""
    return df.where((F.col(column) <= limit) | F.col(column).isNull())


def missing_fraction(df: DataFrame, columns: Sequence[str], threshold: float | None = None) -> DataFrame:
    """(feature, missing_fraction), one scan for all columns; with a threshold also ``exceeds``."""
    shares = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))
    rows = shares.unpivot([], list(columns), "feature", "missing_fraction")
    if threshold is None:
        return rows
    return rows.withColumn("exceeds", F.col("missing_fraction") > threshold)


def report_missing(above: Sequence[str], threshold: float, on_exceed: str) -> None:
    """Warn of the columns whose missing share is above the threshold, or fail."""
    if above:
        message = f"More than {threshold:.0%} missing in: {', '.join(above)}"
        if on_exceed == "fail":
            raise ValidationError(message)
        warnings.warn(message, stacklevel=3)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, median), exact; as many rows as columns."""
    medians = exact_medians(df, columns)
    return small_table(df.sparkSession, [(c, medians[c]) for c in columns], "feature string, median double")
