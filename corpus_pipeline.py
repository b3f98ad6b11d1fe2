"""Preparation of the documents for training: language, repeated lines, near duplicates, leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read back as the next
stage's documents. All but the last return the columns of ``documents``.

- language: documents whose text is null, has no letter, or is far from every language go.
- line_dedup: later copies of repeated runs of 50 words or more are cut out of the texts, and ``n_chars`` follows; a
  document that loses every line goes.
- near_duplicates: of each group of texts linked by a similarity of 0.8 or more in five-word shingles the
  document of the least id stays.
- decontaminate: documents that hold ten consecutive words of a test item (or all of a shorter one) go.
- packing: the rest becomes sequences of 2048 tokens, one row per piece.

An empty table passes through. Columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.llm import decontaminate, jaccard, language, line_runs, packing
from aerofuse.llm.deploy import prepare_tasks
from aerofuse.llm.names import fresh
from aerofuse.session import shared_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_tasks(spark)
    model = language.fit(docs.where(~language.held_out()))
    return language.keep_identified(docs, model)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    [deleted] = fresh(["_deleted"], docs)
    cut = line_runs.without_copies(docs, into=deleted).where(~((F.col(deleted) > 0) & (F.col("text") == "")))
    size = F.when(F.col(deleted) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).drop(deleted)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_tasks(spark)
    return jaccard.keep_one(docs)


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_tasks(spark)
    return decontaminate.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_tasks(spark)
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("line_dedup", cut_repeated_lines),
    ("near_duplicates", keep_one_of_near),
    ("decontaminate", remove_test_items),
    ("packing", pack),
]

# The models, the similarity groups and the packing are beyond SQL; tests/llm compares each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
