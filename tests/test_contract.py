"""Every registered query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_statement_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query_agrees_with_its_statement(spark, duck, name):
    verdict, rows, _ = compare(spark, SF, name, duck)
    assert verdict in ("same", "rows-only")
    assert rows > 0
