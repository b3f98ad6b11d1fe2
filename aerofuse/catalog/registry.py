"""All registered queries and their DuckDB statements."""

from __future__ import annotations

from aerofuse.catalog import aggregates, cleaning, columns, fusion, models, scans, streams

_PARTS = (scans, columns, fusion, aggregates, cleaning, models, streams)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
