"""Scans: files, date ranges, boxes, stations, months and nested landing documents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse.functions import nan_to_null, parse_number, parse_time, station_key
from aerofuse.params import FEATURES, TARGET
from aerofuse.sources import schemas
from aerofuse.sources.rules import require_columns

# A literal IN list longer than this goes through a semi join instead.
MAX_INLINE_STATIONS = 1_000


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
               file_format: str = "parquet", where: Column | None = None) -> DataFrame:
    """Read Parquet, CSV with header, or JSON with a declared schema; NaN becomes NULL.

    ``where`` is applied to the columns as stored, so that it reaches the scan. There NaN is still a
    number above all others: a range with an upper bound leaves it out, as it does NULL.
    """
    reader = spark.read
    if file_format == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    stored = reader.format(file_format).load(path)
    return nan_to_null(stored if where is None else stored.where(where))


def schema_by_header(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a CSV file from its header line: known columns typed, all others text. Nothing is inferred."""
    names = spark.read.option("header", True).csv(path).columns
    return T.StructType([T.StructField(n, schemas.KNOWN_TYPES.get(n, T.StringType())) for n in names])


def read_unified(spark: SparkSession, path: str, file_format: str = "csv",
                 schema: T.StructType | None = None,
                 required: Sequence[str] = (*FEATURES, TARGET)) -> DataFrame:
    """The training table: known types, required columns checked, extra columns kept."""
    if schema is None and file_format == "csv":
        schema = schema_by_header(spark, path)
    return require_columns(read_table(spark, path, schema, file_format), required)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """First of several locations, in order of preference, that exists on its file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(conf).exists(location):
            return path
    raise FileNotFoundError(", ".join(paths))


def between_dates(df: DataFrame, start: datetime, end: datetime, time: str = "time") -> DataFrame:
    """Rows with start <= time <= end, on the raw column so that the scan can skip row groups."""
    return df.where(within_dates(start, end, time, day_column(df, time)))


def day_column(df: DataFrame, time: str, name: str = "date") -> str | None:
    """The column that holds the day of ``time`` in tables partitioned by day; None if there is none."""
    return name if name != time and name in df.columns and isinstance(df.schema[name].dataType, T.DateType) else None


def within_dates(start: datetime, end: datetime, time: str = "time", day: str | None = None) -> Column:
    """start <= time <= end. ``day`` names a partition column with the day of ``time``, which then prunes folders."""
    kept = F.col(time).between(start, end)
    return kept if day is None else kept & F.col(day).between(start.date(), end.date())


def within_months(start: date, end: date, time: str = "time", day: str | None = None) -> Column:
    """Whole calendar months from that of ``start`` to that of ``end``, as a half-open interval on ``time``.

    ``day`` names a partition column with the day of ``time``, or the first day of its month.
    """
    first = datetime(start.year, start.month, 1)
    months = end.year * 12 + end.month
    after = datetime(months // 12, months % 12 + 1, 1)
    kept = (F.col(time) >= first) & (F.col(time) < after)
    return kept if day is None else kept & (F.col(day) >= first.date()) & (F.col(day) < after.date())


def within_box(*, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> Column:
    return F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max)


def only_stations(df: DataFrame, stations: Sequence[str] | DataFrame | None,
                  column: str = "station_id") -> DataFrame:
    """Keep the named stations; ``None`` keeps all. A table of stations is semi-joined."""
    if stations is None:
        return df
    if isinstance(stations, DataFrame):
        return df.join(stations.select(column), column, "left_semi")
    if len(stations) <= MAX_INLINE_STATIONS:
        return df.where(F.col(column).isin(list(stations)))
    wanted = df.sparkSession.createDataFrame([(s,) for s in stations], f"{column} string")
    return df.join(wanted, column, "left_semi")


def in_box(df: DataFrame, *, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> DataFrame:
    return df.where(within_box(lat_min=lat_min, lat_max=lat_max, lon_min=lon_min, lon_max=lon_max))


def in_months(df: DataFrame, start: date, end: date, time: str = "time") -> DataFrame:
    """Rows of whole calendar months; a month without data adds nothing. A day-partitioned table is pruned."""
    return df.where(within_months(start, end, time, day_column(df, time)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of partial loads; columns a part lacks are NULL."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pad_missing(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Add the absent columns as typed NULLs, so that the schema stays the same without a source."""
    return df.withColumns({c: F.lit(None).cast(kind) for c in columns if c not in df.columns})


def long_measurements(df: DataFrame) -> DataFrame:
    """Long measurement file to (station_id, lat, lon, time, parameter, value)."""
    time = F.col("datetimeUtc")
    if isinstance(df.schema["datetimeUtc"].dataType, T.StringType):
        time = parse_time(time)
    return df.select(
        F.col("location_name").alias("station_id"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        time.alias("time"),
        "parameter",
        "value",
    )


def unify_layout(df: DataFrame) -> DataFrame:
    """Accept a measurement file in either layout and return long rows."""
    if "parameter" in df.columns:
        return long_measurements(df) if "datetimeUtc" in df.columns else df
    keys = ["station_id", "lat", "lon", "time"]
    present = [c for c in ("pm25", "pm10") if c in df.columns]
    require_columns(df, [*keys, "pm25"])
    return df.unpivot(keys, present, "parameter", "value").where(F.col("value").isNotNull())


def flatten_landing(df: DataFrame) -> DataFrame:
    """Nested measurement documents to rows, keeping particulate parameters that parse.

    ``results_position`` is the position within the document, the order in which values arrived.
    """
    rows = df.select("city", "location", F.posexplode("results").alias("position", "r"))
    parameter = F.lower("r.parameter")
    return (
        rows.where(parameter.contains("pm"))
        .select(
            station_key(F.col("city"), F.col("location.name"), F.col("location.id")).alias("station_id"),
            "city",
            F.col("location.coordinates.latitude").alias("lat"),
            F.col("location.coordinates.longitude").alias("lon"),
            parse_time(F.col("r.date.utc")).alias("time"),
            parameter.alias("parameter"),
            parse_number(F.col("r.value")).alias("value"),
            F.col("position").alias("results_position"),
        )
        .where(F.col("time").isNotNull() & F.col("value").isNotNull())
    )
