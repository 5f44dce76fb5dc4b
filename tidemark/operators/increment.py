"""High-water mark and the pull above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, delta_col: str) -> DataFrame:
    """One row, ``max``: the highest value of the delta column (NULL when empty)."""
    return df.agg(F.max(delta_col).alias("max"))


def pull_increment(
    df: DataFrame, delta_col: str, after: object, up_to: object = None
) -> DataFrame:
    """All columns of rows above the old mark and, when given, not above the new one.

    The upper bound keeps rows that arrive between reading the mark and copying
    out of this pull, so the next one takes them exactly once. Both bounds are
    plain comparisons that reach the scan.
    """

    kind = df.schema[delta_col].dataType

    def bound(value: object) -> Column:
        # A wall-clock column is compared with the wall-clock text of the mark.
        wall_clock = kind.typeName() == "timestamp_ntz"
        return F.lit(str(value) if wall_clock else value).cast(kind)

    rows = df.filter(F.col(delta_col) > bound(after))
    return rows if up_to is None else rows.filter(F.col(delta_col) <= bound(up_to))
