"""Linear interpolation by row position, and filling of what remains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.ordering import exact_medians, range_shards, with_known_neighbours
from aerofuse.session import materialize


def _between(value: Column, before: Column, after: Column) -> Column:
    """Value on the line between two known neighbours; outside them, the only neighbour's value."""
    share = (F.col("_at") - before["at"]) / (after["at"] - before["at"])
    return (
        F.when(value.isNotNull(), value)
        .when(before.isNull(), after["value"])
        .when(after.isNull(), before["value"])
        .otherwise(before["value"] + (after["value"] - before["value"]) * share)
    )


def interpolate_linear(df: DataFrame, columns: Sequence[str], *, order_by: Sequence[str],
                       partition_by: Sequence[str] = ()) -> DataFrame:
    """Fill gaps on a straight line between the neighbouring known rows, by row position.

    Gaps at either end take the nearest known value; a column unknown throughout a key stays NULL.
    ``(*partition_by, *order_by)`` must identify a row. Without ``partition_by`` the whole table is
    one series. A series of any length is spread over range shards, see ``ordering``.
    """
    laid = range_shards(df, [*partition_by, *order_by])
    values = {c: F.col(c).cast("double") for c in columns}
    swept = with_known_neighbours(laid, partition_by, values)
    filled = {c: _between(values[c], F.col(f"_before_{c}"), F.col(f"_after_{c}")) for c in columns}
    return swept.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in df.columns))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace what is missing by the column's exact median; a column without values stays NULL."""
    medians = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    return df.fillna(medians) if medians else df


@dataclass(frozen=True)
class Gaps:
    """Rows of a table, the values known of each column, and the columns that some key has no value of."""

    rows: int
    known: dict[str, int]
    unknown: tuple[str, ...]

    @property
    def gappy(self) -> list[str]:
        return [c for c, n in self.known.items() if n < self.rows]

    @property
    def empty(self) -> list[str]:
        return [c for c, n in self.known.items() if n == 0 and self.rows]

    def above(self, share: float) -> list[str]:
        """Columns of which more than this share is missing."""
        return [c for c, n in self.known.items() if self.rows and (self.rows - n) / self.rows > share]


def measure_gaps(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = ()) -> Gaps:
    """One aggregate over the source."""
    counts = df.groupBy(*partition_by).agg(F.count("*").alias("_rows"), *(F.count(c).alias(c) for c in columns))
    found = counts.agg(
        F.sum("_rows").alias("_rows"),
        *(F.sum(c).alias(f"known_{c}") for c in columns),
        *(F.max((F.col(c) == 0) & (F.col("_rows") > 0)).alias(f"unknown_{c}") for c in columns),
    ).first()
    return Gaps(
        found["_rows"] or 0,
        {c: found[f"known_{c}"] or 0 for c in columns},
        tuple(c for c in columns if found[f"unknown_{c}"]),
    )


def impute(df: DataFrame, columns: Sequence[str], *, order_by: Sequence[str],
           partition_by: Sequence[str] = (), gaps: Gaps | None = None) -> DataFrame:
    """Interpolate, then fill with medians of the interpolated columns; all ``columns`` become doubles.

    Only columns with gaps are swept. Medians are needed only for columns that are unknown throughout
    some key; if there are any, the interpolated rows are written once, since the median passes and the
    result all read them. ``gaps`` gives the counts if they have been taken.
    """
    gaps = gaps or measure_gaps(df, columns, partition_by)
    gappy, unknown = gaps.gappy, gaps.unknown
    numbers = df.withColumns({c: F.col(c).cast("double") for c in columns})
    if not gappy:
        return numbers
    filled = interpolate_linear(numbers, gappy, order_by=order_by, partition_by=partition_by)
    if not unknown:
        return filled
    written = materialize(filled, "interpolated")
    return fill_median(written, unknown)
