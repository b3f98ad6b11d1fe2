"""Records of text files that do not fit their schema: set aside with their text, file and reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "_broken_record"


def _wrong(schema: T.StructType, text_of) -> Column:
    """Names of the columns whose text, by ``text_of``, is not of their type."""
    return F.array_compact(F.array(*(
        F.when(text_of(k, f).isNotNull() & text_of(k, f).try_cast(f.dataType).isNull(), F.lit(f.name)) for k, f in enumerate(schema.fields))))


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType, file_format: str = "csv",
                 **options: str) -> tuple[DataFrame, DataFrame]:
    """(records that fit the schema, broken ones: file, record, reason) of CSV with header or JSON lines.

    A CSV record is broken if it has too many or too few fields or a value that is not of its column's type, a JSON record if
    it is no object of the schema. Missing values and absent JSON fields are not broken.
    """
    if file_format not in ("csv", "json"):
        raise ValueError("records are read from csv or json")
    whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN).options(**options)
    if file_format == "csv":
        reader = reader.option("header", options.get("header", "true")).option("enforceSchema", True)
    rows = reader.format(file_format).load(path)
    names = schema.names
    # A value is looked at only if its column is asked for, so every column is, by a condition that always holds.
    read = F.xxhash64(*(F.col(f"`{n}`") for n in names)).bitwiseOR(F.lit(1)) != 0
    sound = rows.where(F.col(BROKEN).isNull() & read).select(*(f"`{n}`" for n in names))
    set_aside = rows.where(F.col(BROKEN).isNotNull() & read).select(
        F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("record"), F.struct(*(f"`{n}`" for n in names)).alias("seen"))
    if file_format == "csv":
        as_text = F.from_csv("record", F.lit(", ".join(f"c{k} STRING" for k in range(len(names)))), {"mode": "PERMISSIVE"})
        # Commas within quotes do not part fields.
        fields = F.size(F.split(F.regexp_replace("record", '"[^"]*"', ""), ","))
        broken = set_aside.withColumn("text", as_text).withColumn("fields", fields)
        wrong = _wrong(schema, lambda k, f: F.col(f"text.c{k}"))
        unfit = F.when(F.col("fields") != len(names), F.concat(F.col("fields"), F.lit(f" fields, not {len(names)}")))
    else:
        broken = set_aside.withColumn("text", F.from_json("record", "map<string,string>"))
        # Nested values are given by their JSON, which is of their type unless it was not read.
        wrong = F.array_compact(F.array(*(
            F.when(F.col("text")[f.name].isNotNull() & F.col("seen")[f.name].isNull(), F.lit(f.name)) for f in schema.fields)))
        unfit = F.when(F.col("text").isNull() | (F.size("text") == 0), "no JSON object")
    broken = broken.withColumn("wrong", wrong)
    reason = unfit.when(F.size("wrong") > 0, F.concat(F.lit("type of "), F.array_join("wrong", ", "))).otherwise("unreadable")
    return sound, broken.select("file", "record", reason.alias("reason"))
