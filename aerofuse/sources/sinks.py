"""Writers for tables, prediction logs and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def project_available(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select([name for name in order if name in df.columns])


def write_table(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists",
                partition_by: Sequence[str] = (), columns: Sequence[str] | None = None) -> None:
    """Write a table; the parent folders are made by the file system layer.

    With ``partition_by`` the rows are clustered first, as in ``append_log``.
    """
    rows = project_available(df, columns) if columns else df
    if partition_by and not df.isStreaming:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode(mode)
    if file_format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(file_format).save(path)


def append_log(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Append predictions to the log, partitioned by day.

    Rows are clustered by day first, so a task does not open a file for every day; the
    rebalance lets AQE cut a heavy day into several files.
    """
    dated = df.withColumn("date", F.to_date(time))
    dated.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON document with the fields rmse, mae, r2."""
    metrics.select("rmse", "mae", "r2").coalesce(1).write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("rmse double, mae double, r2 double").json(path)
