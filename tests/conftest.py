from __future__ import annotations

import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aerofuse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "8g")


@pytest.fixture
def many_shards(spark):
    """Keep small inputs in many partitions, so that rows of one key really meet shard borders."""
    with settings(spark, {
        "spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }):
        yield


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
