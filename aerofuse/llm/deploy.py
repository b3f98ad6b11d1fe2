"""What Python tasks need: the package, wherever the driver found it, and batches that fit in memory."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Texts vary from a word to many megabytes, so a batch is bounded by rows and by bytes.
BATCH_ROWS = "1000"
BATCH_BYTES = "16m"

_sent: set = set()


def prepare_tasks(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    send_package(spark)


def send_package(spark: SparkSession) -> None:
    """Hand the package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "aerofuse-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
