"""Names for helper columns that the frames at hand do not have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def fresh(wanted: Sequence[str], *frames: DataFrame) -> list[str]:
    """``wanted``, each with underscores added until no frame has a column of that name, in any letter case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    out: list[str] = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
