"""Newest version per key, inside one frame or against stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merge import merge_rows


def _newest_first(names: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]


def keep_latest(
    df: DataFrame, key: str | Sequence[str], version: str, ties: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the highest version, ties broken by the highest ``ties``.

    ``row_number() = 1`` lets Spark cut every map-side partition to one row per
    key before the shuffle, so a key with a third of all versions sends at most
    one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = Window.partitionBy(*keys).orderBy(*_newest_first([version, *ties]))
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_latest(
    stored: DataFrame,
    batch: DataFrame,
    key: str,
    version: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Stored rows (one per key) brought up to date by a batch (one per key).

    A stored row gives way to a higher (version, ties) only, so a row sent again
    unchanged keeps its stored copy with its load time. Both sides are unique by
    key, so the join cannot skew.
    """
    order = [version, *ties]
    newer = F.struct(*(F.col(f"s_{n}") for n in order)) > F.struct(
        *(F.col(f"t_{n}") for n in order)
    )
    columns = {name: (F.col(f"s_{name}"), F.col(f"s_{name}")) for name in stored.columns}
    return merge_rows(stored, batch, key, newer, columns)


def merge_versions(
    stored: DataFrame,
    versions: DataFrame,
    key: str,
    version: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """:func:`merge_latest` of a batch that still has every version of its keys.

    Stored rows and versions are ranked together, the stored row first among equals, so
    one shuffle and one sort do what :func:`keep_latest`, the check for repeated keys and
    the join would do one after another.
    """
    rows = stored.withColumn("_stored", F.lit(True)).unionByName(
        versions.withColumn("_stored", F.lit(False))
    )
    return keep_latest(rows, key, version, [*ties, "_stored"]).drop("_stored")
