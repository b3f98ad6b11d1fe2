"""Files that cannot be read: kept out one by one, each with a row in an error table.

A month or a location that fails costs its own file and nothing else. What is read is compared with what is listed:
a file is bad if it gives no rows although it has bytes and its reader fails on it, or fewer rows than its own
footer promises.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERRORS = "file string, bytes long, reason string"


def listed_files(spark: SparkSession, path: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """file, bytes of every file below ``path`` whose name fits; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def _reasons(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, reason of those among ``files`` that fail, each looked at by one task."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, reasons = [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    for _ in pq.ParquetFile(pa.BufferReader(content.as_buffer())).iter_batches():
                        pass
                except Exception as error:  # whatever is wrong with a file is its reason
                    names.append(name)
                    reasons.append(str(error).split("\n")[0][:200] or type(error).__name__)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(reasons, pa.string())], names=["file", "reason"])

    contents = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), "content")
    return contents.mapInArrow(look, "file string, reason string")


def read_readable(spark: SparkSession, path: str | list[str], schema: T.StructType, verify: bool = True,
                  pattern: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """(rows of all Parquet files that can be read, error table: file, bytes, reason).

    A file that is cut off in the middle would give its first rows only; with ``verify`` all columns are read once
    beforehand to find such files, without it only files that cannot be opened are found.
    """
    listed = {r["file"]: r["bytes"] for r in listed_files(spark, path, pattern).collect()}  # as the scan itself lists them
    if not listed:
        return spark.createDataFrame([], schema), spark.createDataFrame([], ERRORS)
    lenient = spark.read.schema(schema).option("ignoreCorruptFiles", True)
    rows = lenient.parquet(*sorted(listed))
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("file"))
    promised = {r["file"]: r["n"] for r in by_file.agg(F.count(F.lit(1)).alias("n")).collect()}  # from the footers
    if verify:
        # A count alone would be answered from the footers, a digest has to read every value.
        whole = by_file.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*schema.names)).alias("digest"))
        read = {r["file"]: r["n"] for r in whole.collect()}
    else:
        read = promised
    doubtful = [f for f in listed if f not in promised or read.get(f, 0) < promised[f]]
    errors = spark.createDataFrame([], ERRORS)
    bad: set = set()
    if doubtful:
        found = {r["file"]: r["reason"] for r in _reasons(spark, doubtful).collect()}
        # What Spark could not read whole is bad even if another reader can.
        found |= {f: "fewer rows than its footer promises" for f in doubtful if f not in found and read.get(f, 0) < promised.get(f, 0)}
        bad = set(found)
        if bad:
            errors = spark.createDataFrame([(f, listed[f], found[f]) for f in sorted(bad)], ERRORS)
    good = [f for f in sorted(listed) if f not in bad]
    return (spark.read.schema(schema).parquet(*good) if good else spark.createDataFrame([], schema)), errors
