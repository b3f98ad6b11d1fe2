"""Tables laid out by place, so that a box reads the files that can hold it and no others.

A place's key interleaves the bits of its latitude and longitude cells (a Z-order curve). The table is range-partitioned
and sorted by the key, files are of even row counts however the places crowd, and a small index says which
keys each file holds. A box is a few ranges of keys; files that meet none of them are not opened, and within a
file the key's statistics skip row groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerofuse.functions import nan_to_null
from aerofuse.sources.readers import within_box

BITS = 20  # of each axis: cells of 38 m by 19 m at the equator
KEY = "place_key"
FILE_ROWS = 2_000_000
TASK_ROWS = 1_000_000  # rows that a task sorts and cuts into files
MAX_RANGES = 64  # a box is covered by at most so many ranges of keys, larger ones where it needs more


def _cell(value: Column, low: float, width: float) -> Column:
    cell = F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(1 << BITS)))
    return F.least(F.greatest(cell, F.lit(0)), F.lit((1 << BITS) - 1)).cast("long")


def _spread(cell: Column) -> Column:
    """The bits of a cell number, with room for another bit between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        cell = (cell.bitwiseOR(F.shiftleft(cell, shift))).bitwiseAND(F.lit(mask))
    return cell


def place_key(lat: Column, lon: Column) -> Column:
    """Place on the curve; null if either is missing. Values out of range count as those at the edge."""
    return F.shiftleft(_spread(_cell(lat, -90, 180)), 1).bitwiseOR(_spread(_cell(lon, -180, 360)))


def box_ranges(*, lat_min: float, lat_max: float, lon_min: float, lon_max: float, most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Ascending ranges of keys, both ends included, that hold every place of the box."""

    def cell(value: float, low: float, width: float) -> int:
        return min(max(int((value - low) // (width / (1 << BITS))), 0), (1 << BITS) - 1)

    # One cell more on each side, since the division above may round otherwise than that of the column.
    south, north = max(cell(lat_min, -90, 180) - 1, 0), min(cell(lat_max, -90, 180) + 1, (1 << BITS) - 1)
    west, east = max(cell(lon_min, -180, 360) - 1, 0), min(cell(lon_max, -180, 360) + 1, (1 << BITS) - 1)
    squares, whole = [(0, 0, BITS)], []  # lower corner in cells, and the bits below
    while squares and len(squares) * 4 + len(whole) <= most:
        finer = []
        for y, x, bits in squares:
            size = 1 << bits
            if y + size - 1 < south or y > north or x + size - 1 < west or x > east:
                continue
            if (y >= south and y + size - 1 <= north and x >= west and x + size - 1 <= east) or not bits:
                whole.append((y, x, bits))
            else:
                half = size >> 1
                finer += [(y + dy, x + dx, bits - 1) for dy in (0, half) for dx in (0, half)]
        squares = finer
    squares = [(y, x, b) for y, x, b in squares
               if not (y + (1 << b) - 1 < south or y > north or x + (1 << b) - 1 < west or x > east)]

    def code(y: int, x: int) -> int:
        return sum((y >> k & 1) << 2 * k + 1 | (x >> k & 1) << 2 * k for k in range(BITS))

    found = sorted((code(y, x), code(y, x) + (1 << 2 * b) - 1) for y, x, b in whole + squares)
    out: list = []
    for low, high in found:
        if out and low == out[-1][1] + 1:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def write_by_place(df: DataFrame, path: str, file_rows: int = FILE_ROWS, lat: str = "lat", lon: str = "lon") -> None:
    """Write ``path/rows``, sorted by place into files of at most ``file_rows`` rows, and ``path/index``.

    A task writes as many files as its rows make, so that small files do not mean as many tasks, each of which
    would be sampled for and answer to the driver.
    """
    rows = df.count()
    files = max(1, -(-rows // file_rows))
    tasks = min(files, max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism))
    keyed = df.withColumn(KEY, place_key(F.col(lat), F.col(lon)))
    # Rows of one place are dealt over several files by a hash of the row, so that a crowded place is no single task.
    order = [KEY, F.xxhash64(*df.columns)]
    keyed.repartitionByRange(tasks, *order).sortWithinPartitions(KEY).write.option("maxRecordsPerFile", file_rows).parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(f"{KEY} long").parquet(f"{path}/rows")
    index = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(KEY).alias("low"), F.max(KEY).alias("high"), F.count(F.lit(1)).alias("rows"))
    index.coalesce(1).write.parquet(f"{path}/index")  # a row a file


def files_of_box(spark: SparkSession, path: str, **box: float) -> list[str]:
    """The files that can hold a place of the box."""
    index = spark.read.schema("file string, low long, high long, rows long").parquet(f"{path}/index")
    meets = [(F.col("low") <= high) & (F.col("high") >= low) for low, high in box_ranges(**box)]
    return sorted(r["file"] for r in index.where(reduce(lambda a, b: a | b, meets)).collect())


def read_box(spark: SparkSession, path: str, schema: T.StructType, **box: float) -> DataFrame:
    """The rows of a box (lat_min, lat_max, lon_min, lon_max) of a table that ``write_by_place`` has written."""
    files = files_of_box(spark, path, **box)
    if not files:
        return spark.createDataFrame([], schema)
    keyed = T.StructType([*schema.fields, T.StructField(KEY, T.LongType())])
    rows = spark.read.schema(keyed).parquet(*(f"{path}/rows/{f}" for f in files))
    near = reduce(lambda a, b: a | b, (F.col(KEY).between(low, high) for low, high in box_ranges(**box)))
    return nan_to_null(rows.where(within_box(**box) & near).select(*schema.names))
