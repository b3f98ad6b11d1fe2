"""Decorator that registers a query together with its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse.catalog.fixtures import spark_view, with_views


class Part:
    """The queries of one subject."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, *views: str, sql: str | None = None, name: str | None = None):
        """The function gets the named views (or base tables) as DataFrames, in that order."""

        def register(function: Callable[..., DataFrame]):
            key = name or function.__name__

            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(*(spark_view(spark, sf_dir, v) for v in views))

            self.queries[key] = run
            if sql is not None:
                self.oracles[key] = with_views(sql, views)
            return function

        return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every floating column rounded, since the engines may differ in the last bits."""
    return df.select(*(_rounded(f, digits) for f in df.schema.fields))


def _rounded(field: T.StructField, digits: int) -> Column:
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.round(field.name, digits).alias(field.name)
    return F.col(field.name)
