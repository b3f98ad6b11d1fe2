"""Declared schemas of the tables the engine reads."""

from __future__ import annotations

from pyspark.sql import types as T

from aerofuse.params import FEATURES, TARGET

_ts, _double, _string, _int = T.TimestampNTZType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Names and types of the files that are read and written.
STATION = _struct(time=_ts, lat=_double, lon=_double, pm25=_double, pm10=_double, station_id=_string)
AEROSOL = _struct(time=_ts, lat=_double, lon=_double, aod=_double, cloud_fraction=_double)
WEATHER = _struct(
    time=_ts,
    lat=_double,
    lon=_double,
    temperature=_double,
    humidity=_double,
    wind_speed=_double,
    boundary_layer_height=_double,
)
# Times of long measurements arrive as ISO text with a zone and are parsed after the read.
LONG_MEASUREMENT = _struct(
    location_id=_string,
    location_name=_string,
    parameter=_string,
    value=_double,
    unit=_string,
    datetimeUtc=_string,
    latitude=_double,
    longitude=_double,
)
LANDING = T.StructType(
    [
        T.StructField("city", _string),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", _string),
                    T.StructField("coordinates", _struct(latitude=_double, longitude=_double)),
                ]
            ),
        ),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("parameter", _string),
                        # Read as text, so that one unreadable value costs one row and not the document.
                        T.StructField("value", _string),
                        T.StructField("date", _struct(utc=_string)),
                    ]
                )
            ),
        ),
    ]
)
UNIFIED = T.StructType(
    [T.StructField(name, _int if name == "day_of_year" else _double) for name in (*FEATURES, TARGET)]
)
# Types of columns by name, for CSV files that may hold extra columns in any order; others are text.
KNOWN_TYPES = {
    f.name: f.dataType
    for schema in (LONG_MEASUREMENT, STATION, AEROSOL, WEATHER, UNIFIED)
    for f in schema.fields
}
FUSED_COLUMNS = (
    "time",
    "lat",
    "lon",
    "station_id",
    "pm25",
    "pm10",
    "aod",
    "cloud_fraction",
    "temperature",
    "humidity",
    "wind_speed",
    "boundary_layer_height",
)
TRAINING_COLUMNS = (
    "time",
    "lat",
    "lon",
    "pm25",
    "pm10",
    "aod",
    "cloud_fraction",
    "temperature",
    "humidity",
    "wind_speed",
    "boundary_layer_height",
    "day_of_year",
    "station_id",
)
