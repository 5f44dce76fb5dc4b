"""Merge of a source into a target by key.

Parquet tables have no row-level MERGE, so a merge yields the whole new state
and the caller publishes it as a new version (see ``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """The same rows; the query fails when a key occurs twice.

    The window needs the same hash partitioning and order as a following
    sort-merge join on the key, so the check adds no shuffle of its own.
    """
    counted = df.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(key)))
    once = F.assert_true(F.col("_copies") == 1, F.lit(f"merge source repeats a value of {key}"))
    return counted.filter(once.isNull()).drop("_copies")


def pair_up(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of both sides next to each other, as ``t_<column>`` and ``s_<column>``.

    ``_stored`` and ``_sent`` are NULL where a side has no row. One full outer join
    whatever the sizes; a small batch is kept from moving a large state by giving it
    only the parts of the state that its keys lie in (see ``sources.versions``).
    """
    t = target.select(
        *(F.col(c).alias(f"t_{c}") for c in target.columns), F.lit(True).alias("_stored")
    )
    s = unique_by(source, key).select(
        *(F.col(c).alias(f"s_{c}") for c in source.columns), F.lit(True).alias("_sent")
    )
    return t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_when: Column,
    columns: Mapping[str, tuple[Column | None, Column]],
) -> DataFrame:
    """New state of ``target`` after merging ``source``; see :func:`pair_up`.

    ``columns`` gives per target column the value on update (None keeps the
    stored one) and the value on insert. Rows on one side only are kept or
    inserted; matched rows change where ``update_when`` is true.
    """
    insert = F.col("_stored").isNull()
    update = F.col("_sent").isNotNull() & F.coalesce(update_when, F.lit(False))

    def merged(name: str) -> Column:
        on_update, on_insert = columns[name]
        value = F.when(insert, on_insert)
        if on_update is not None:
            value = value.when(update, on_update)
        return value.otherwise(F.col(f"t_{name}")).alias(name)

    return pair_up(target, source, key).select(*map(merged, target.columns))
