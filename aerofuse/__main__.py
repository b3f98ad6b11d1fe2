"""Jobs for spark-submit: fuse the sources, load measured values, train a model, score a table.

spark-submit --py-files aerofuse.zip run.py fuse|load|train|score ..., or python -m aerofuse on one machine.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse import sources
from aerofuse.operators.ordering import with_position
from aerofuse.params import ForestParams, FusionParams, TrainingParams
from aerofuse.plans import training
from aerofuse.plans.fusion import ON_INVALID, fuse_period, validated
from aerofuse.plans.preprocess import LOAD_PARAMS, load_measured, preprocess
from aerofuse.session import materialize, prepare
from aerofuse.sources import schemas


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="aerofuse")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    jobs = parser.add_subparsers(dest="job", required=True)

    fuse = jobs.add_parser("fuse", help="stations with the nearest aerosol and weather values")
    fuse.add_argument("--start", type=datetime.fromisoformat, required=True)
    fuse.add_argument("--end", type=datetime.fromisoformat, required=True)
    fuse.add_argument("--station", action="append")
    load = jobs.add_parser("load", help="as fuse, then measured values of a long or wide file put in place")
    load.add_argument("--measurements", required=True)
    for job, radii in ((fuse, FusionParams), (load, LOAD_PARAMS)):
        for name in ("stations", "aerosol", "weather", "output"):
            job.add_argument(f"--{name}", required=True)
        job.add_argument("--aerosol-radius-km", type=float, default=radii.aerosol_radius_km)
        job.add_argument("--weather-radius-km", type=float, default=radii.weather_radius_km)
        job.add_argument("--on-invalid", choices=ON_INVALID, default="fail", help="rows that break a range rule")
        job.add_argument("--rejected", help="folder for rows set aside by --on-invalid split")

    train = jobs.add_parser("train", help="prepare, split, fit, evaluate, keep model and metrics")
    train.add_argument("--input", action="append", required=True, help="may be repeated; the first that exists is read")
    train.add_argument("--key", action="append", required=True, help="columns that identify a row")
    train.add_argument("--series", action="append", default=[], help="columns that identify a series to interpolate")
    train.add_argument("--output", required=True)
    train.add_argument("--trees", type=int, default=ForestParams.trees)
    train.add_argument("--max-depth", type=int, default=ForestParams.max_depth)
    train.add_argument("--fit-rows", type=int, help="most training rows to fit on; all, if left out")
    train.add_argument("--ordered", action="store_true", help="test on the latest rows instead of shuffled ones")

    score = jobs.add_parser("score", help="add predicted_pm25 to a table")
    for name in ("model", "input", "output"):
        score.add_argument(f"--{name}", required=True)
    return parser.parse_args(argv)


def _read(spark: SparkSession, args: argparse.Namespace, path: str, schema: T.StructType) -> DataFrame:
    if args.format == "csv":
        schema = sources.schema_by_header(spark, path)
    return sources.read_table(spark, path, None if args.format == "parquet" else schema, args.format)


def _three_sources(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    declared = ((args.stations, schemas.STATION), (args.aerosol, schemas.AEROSOL), (args.weather, schemas.WEATHER))
    return [sources.check_schema(_read(spark, args, path, schema), schema.names) for path, schema in declared]


def _radii(args: argparse.Namespace) -> FusionParams:
    return FusionParams(aerosol_radius_km=args.aerosol_radius_km, weather_radius_km=args.weather_radius_km)


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows numbered by time, place and then all their other columns, whatever files they came in.

    Of two readings for one target the one of the greater number wins. Rows that agree in every column may swap numbers.
    """
    first = [c for c in ("time", "lat", "lon") if c in rows.columns]
    ordered = [f.name for f in rows.schema if f.name not in first and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return with_position(rows, ["`" + c.replace("`", "``") + "`" for c in (*first, *sorted(ordered))], name=name)


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    frames = [
        validated(frame, rules, args.on_invalid, args.rejected, name)
        for frame, rules, name in zip(
            _three_sources(spark, args), (sources.STATION_RULES, sources.AEROSOL_RULES, sources.WEATHER_RULES),
            ("stations", "aerosol", "weather"), strict=True,
        )
    ]
    readings = sources.unify_layout(_read(spark, args, args.measurements, schemas.LONG_MEASUREMENT))
    readings = validated(readings, sources.STATION_RULES, args.on_invalid, args.rejected, "measurements")
    stations, readings = _numbered(frames[0], "row_number"), _numbered(readings, "reading_number")
    loaded = load_measured(
        readings, stations, *frames[1:], row_key="row_number", measurement_key="reading_number", params=_radii(args),
    )
    sources.write_table(loaded, args.output, args.format, mode="overwrite", columns=schemas.TRAINING_COLUMNS)


def _fuse(spark: SparkSession, args: argparse.Namespace) -> None:
    fused = fuse_period(
        *_three_sources(spark, args), args.start, args.end, args.station, _radii(args), on_invalid=args.on_invalid,
        rejected=args.rejected,
    )
    sources.write_table(fused, args.output, args.format, mode="overwrite", columns=schemas.FUSED_COLUMNS)


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    params = TrainingParams(
        shuffle=not args.ordered, forest=ForestParams(trees=args.trees, max_depth=args.max_depth), fit_rows=args.fit_rows,
    )
    path = sources.first_existing(spark, args.input)
    measured = [f for f in params.features if f != "day_of_year"]  # derived from the time by preprocess
    table = sources.read_unified(spark, path, args.format, required=[*measured, params.target])
    order = [*(["time"] if "time" in table.columns else []), *args.key]
    ready = materialize(preprocess(table, params, order_by=order, partition_by=args.series), "prepared")
    _, metrics = training.train_and_evaluate(ready, args.key, params, args.output)
    print(metrics.first().asDict())


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    table = sources.read_unified(spark, args.input, args.format, required=())
    if "day_of_year" not in table.columns and "time" in table.columns:
        table = table.withColumn("day_of_year", F.dayofyear("time"))
    training.score_file(training.load_model(args.model), table, args.output, file_format=args.format)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = prepare(SparkSession.builder.appName(f"aerofuse {args.job}").getOrCreate())
    {"fuse": _fuse, "load": _load, "train": _train, "score": _score}[args.job](spark, args)


if __name__ == "__main__":
    main()
