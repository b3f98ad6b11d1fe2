"""Order-dependent operators and the cleaning chain."""

from __future__ import annotations


from aerofuse.catalog.aggregates import FEATURE_COLUMNS
from aerofuse.catalog.binding import Part, rounded
from aerofuse.operators import interpolate
from aerofuse.operators.ordering import with_position
from aerofuse.operators.quality import drop_missing_target as drop_missing
from aerofuse.operators.split import mark_test
from aerofuse.params import TrainingParams
from aerofuse.plans import preprocess as preparation

part = Part()
ORDER = ("time", "event_id")


def _interpolated_sql(source: str, columns: tuple[str, ...], name: str, keyed: bool = True) -> str:
    """Neighbouring known rows found with window functions, then the line between them."""
    by = "PARTITION BY station_id " if keyed else ""
    before = f"({by}ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"({by}ORDER BY time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    ends = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER {before} AS {c}_pv, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN n END IGNORE NULLS) OVER {before} AS {c}_pn, "
        f"first_value({c} IGNORE NULLS) OVER {after} AS {c}_nv, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN n END IGNORE NULLS) OVER {after} AS {c}_nn"
        for c in columns
    )
    lines = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pn IS NULL THEN {c}_nv WHEN {c}_nn IS NULL THEN {c}_pv "
        f"ELSE {c}_pv + ({c}_nv - {c}_pv) * ((n - {c}_pn) / CAST({c}_nn - {c}_pn AS DOUBLE)) END AS {c}"
        for c in columns
    )
    return f"""{name}_n AS (SELECT *, row_number() OVER ({by}ORDER BY time, event_id) AS n FROM {source}),
    {name}_e AS (SELECT *, {ends} FROM {name}_n),
    {name} AS (SELECT event_id, station_id, time, lat, lon, pm25, {lines} FROM {name}_e)"""


ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_COLUMNS)
IMPUTED = ", ".join(f"round(coalesce({c}, (SELECT median({c}) FROM filled)), 6) AS {c}" for c in FEATURE_COLUMNS)


@part.query("features", sql=f"""
    , {_interpolated_sql('features', FEATURE_COLUMNS, 'filled')}
    SELECT event_id, station_id, time, lat, lon, pm25, {ROUNDED} FROM filled""")
def interpolate_linear(features):
    return rounded(
        interpolate.interpolate_linear(features, FEATURE_COLUMNS, order_by=ORDER, partition_by=("station_id",))
    )


@part.query("features", sql=f"""
    , {_interpolated_sql('features', FEATURE_COLUMNS, 'filled', keyed=False)}
    SELECT event_id, station_id, time, lat, lon, pm25, {ROUNDED} FROM filled""")
def interpolate_whole_table(features):
    return rounded(interpolate.interpolate_linear(features, FEATURE_COLUMNS, order_by=ORDER))


@part.query("features", sql=f"""
    , {_interpolated_sql('features', FEATURE_COLUMNS, 'filled')}
    SELECT event_id, station_id, time, lat, lon, pm25, {IMPUTED} FROM filled""")
def impute(features):
    return rounded(interpolate.impute(features, FEATURE_COLUMNS, order_by=ORDER, partition_by=("station_id",)))


@part.query("features", sql=f"""
    , kept AS (SELECT * FROM features WHERE pm25 IS NOT NULL),
    {_interpolated_sql('kept', FEATURE_COLUMNS, 'filled')}
    SELECT event_id, station_id, time, lat, lon, pm25, {IMPUTED},
           CAST(dayofyear(time) AS DOUBLE) AS day_of_year FROM filled""")
def preprocess(features):
    return rounded(preparation.preprocess(features, order_by=ORDER, partition_by=("station_id",)))


@part.query("features", sql="SELECT event_id, pm25 FROM features WHERE pm25 IS NOT NULL")
def drop_missing_target(features):
    return drop_missing(features, "pm25").select("event_id", "pm25")


@part.query("scored", sql="""
    SELECT event_id, station_id, p, row_number() OVER (PARTITION BY station_id ORDER BY time, event_id) AS number
    FROM scored""")
def prediction_trend(scored):
    numbered = with_position(scored, ORDER, ["station_id"], "number")
    return numbered.select("event_id", "station_id", "p", "number")


@part.query("features", sql="""
    SELECT event_id, row_number() OVER (ORDER BY md5(concat_ws('-', CAST(event_id AS VARCHAR), '42')))
        <= ceil((SELECT count(*) FROM features) * 0.2) AS is_test FROM features""")
def split_exact(features):
    return mark_test(features.select("event_id"), TrainingParams(), ["event_id"])


@part.query("features", sql="""
    SELECT event_id, time, row_number() OVER (ORDER BY time, event_id)
        > (SELECT count(*) FROM features) - ceil((SELECT count(*) FROM features) * 0.2) AS is_test FROM features""")
def split_ordered(features):
    return mark_test(features.select("event_id", "time"), TrainingParams(shuffle=False), ["event_id"])


@part.query("obs", sql="SELECT event_id, time, pm25 FROM obs ORDER BY time, event_id")
def sort_time(obs):
    return obs.select("event_id", "time", "pm25").orderBy(*ORDER)


QUERIES, ORACLES = part.queries, part.oracles
