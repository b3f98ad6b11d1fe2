from aerofuse.functions.airquality import (
    advice_table,
    aqi_category,
    aqi_index,
    delta_to_reference,
)
from aerofuse.functions.geo import haversine_km, snap_to_grid
from aerofuse.functions.meteorology import relative_humidity, season, wind_speed
from aerofuse.functions.scalars import (
    clip,
    day_of_year,
    nan_to_null,
    parse_number,
    parse_time,
    station_key,
    with_time_features,
)

__all__ = [
    "advice_table",
    "aqi_category",
    "aqi_index",
    "clip",
    "day_of_year",
    "delta_to_reference",
    "haversine_km",
    "nan_to_null",
    "parse_number",
    "parse_time",
    "relative_humidity",
    "season",
    "snap_to_grid",
    "station_key",
    "wind_speed",
    "with_time_features",
]
