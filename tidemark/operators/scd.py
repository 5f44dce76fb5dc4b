"""Dimension upserts: current state only, and versioned history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import OPEN_END, row_hash, row_hash_plain, rows_differ, stamp
from .merge import merge_rows, pair_up, unique_by

# Audit labels written by the loads.
INSERTED_BY = "databricks"
SCD1_UPDATED_BY = "databricks-updated"
SCD2_UPDATED_BY = "Databricks-Updated"

AUDIT = ("CREATEDDATE", "CREATEDBY", "UPDATEDDATE", "UPDATEDBY")


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: object = None,
    changed_by: str = "columns",
    inserted_by: str = INSERTED_BY,
    updated_by: str = SCD1_UPDATED_BY,
) -> DataFrame:
    """New state of a dimension that keeps one row per key.

    ``changed_by="columns"`` compares the tracked columns themselves;
    ``"hash"`` compares stored and fresh row hashes, and so overlooks what the
    separated text of the columns cannot tell apart (NULLs are skipped).
    """
    now = stamp(as_of)
    if changed_by == "hash":
        hashed = row_hash_plain(key, *tracked, separator="||")
        differs = F.col("t_HASHVALUE") != F.col("s_HASHVALUE")
    else:
        hashed = row_hash(key, *tracked)
        differs = rows_differ("t_", "s_", tracked)
    fresh = source.select(key, *tracked).withColumn("HASHVALUE", hashed)
    columns: dict[str, tuple[Column | None, Column]] = {
        name: (F.col(f"s_{name}"), F.col(f"s_{name}")) for name in fresh.columns
    }
    columns["CREATEDDATE"] = (None, now)
    columns["CREATEDBY"] = (None, F.lit(inserted_by))
    columns["UPDATEDDATE"] = (now, now)
    columns["UPDATEDBY"] = (F.lit(updated_by), F.lit(inserted_by))
    return merge_rows(target, fresh, key, differs, columns)


def scd2_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: object = None,
    against: str = "active",
) -> DataFrame:
    """New state of a dimension that keeps every version of a key.

    ``against="active"`` compares a source row with the active version, column
    by column. ``"all_versions"`` is the plain hash rule: a row counts as new
    only when no version, open or closed, has its hash, and a NULL in a tracked
    column makes the hash NULL, which never equals anything.
    """
    if against == "all_versions":
        return _against_history(target, source, key, tracked, as_of)
    fresh = source.select(key, *tracked).withColumn("HASHVALUE", row_hash(key, *tracked))
    is_active = F.col("IS_ACTIVE").eqNullSafe(F.lit(1))
    pairs = pair_up(unique_by(target.filter(is_active), key), fresh, key)
    inserted = F.col("_stored").isNull()
    changed = (
        F.col("_stored").isNotNull()
        & F.col("_sent").isNotNull()
        & rows_differ("t_", "s_", tracked)
    )
    # A changed key yields two rows, the closed version and the new one.
    sides = F.when(changed, F.array(F.lit("old"), F.lit("new"))).otherwise(
        F.array(F.when(inserted, F.lit("new")).otherwise(F.lit("old")))
    )
    new_row = _new_version("s_", key, tracked, as_of)
    closed = _closing(as_of)
    current = pairs.withColumn("_changed", changed).withColumn("_side", F.explode(sides)).select(
        *(
            F.when(F.col("_side") == "new", new_row[name])
            .when(F.col("_changed"), closed.get(name, F.col(f"t_{name}")))
            .otherwise(F.col(f"t_{name}"))
            .alias(name)
            for name in target.columns
        )
    )
    # Closed versions take no part in the join, so history is never shuffled.
    return target.filter(~is_active).unionByName(current)


def scd2_changed_keys(
    target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Source rows whose key has an active version that differs, as ``MergeKey`` + row."""
    active = target.filter(F.col("IS_ACTIVE") == 1)
    return (
        source.select(key, *tracked)
        .alias("new")
        .join(active.alias("old"), F.col(f"new.{key}") == F.col(f"old.{key}"), "inner")
        .where(rows_differ("new.", "old.", tracked))
        .select(F.col(f"new.{key}").alias("MergeKey"), "new.*")
    )


def _against_history(
    target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], as_of: object
) -> DataFrame:
    hashed = unique_by(source.select(key, *tracked), key).withColumn(
        "HASHVALUE", row_hash_plain(key, *tracked)
    )
    # One (key, hash) pair is enough to know a version; this thins a long history
    # before it is shuffled.
    known = target.select(key, "HASHVALUE").distinct()
    new = hashed.join(known, [key, "HASHVALUE"], "left_anti")
    active = target.filter(F.col("IS_ACTIVE") == 1)
    closed = _closing(as_of)
    differs = F.col("t.HASHVALUE") != F.col("s.HASHVALUE")
    kept = (
        active.alias("t")
        .join(new.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
        .select(
            *(
                F.when(differs, closed[name]).otherwise(F.col(f"t.{name}")).alias(name)
                if name in closed
                else F.col(f"t.{name}")
                for name in target.columns
            )
        )
    )
    row = _new_version("s.", key, tracked, as_of)
    inserts = new.alias("s").select(*(row[name].alias(name) for name in target.columns))
    past = target.filter(~F.col("IS_ACTIVE").eqNullSafe(F.lit(1)))
    return past.union(kept).union(inserts)


def _new_version(
    prefix: str, key: str, tracked: Sequence[str], as_of: object
) -> dict[str, Column]:
    row = {name: F.col(f"{prefix}{name}") for name in (key, *tracked, "HASHVALUE")}
    row["CREATEDDATE"] = stamp(as_of)
    row["CREATEDBY"] = F.lit(INSERTED_BY)
    row["UPDATEDDATE"] = F.to_timestamp(F.lit(OPEN_END))
    row["UPDATEDBY"] = F.lit(INSERTED_BY)
    row["IS_ACTIVE"] = F.lit(1)
    return row


def _closing(as_of: object) -> dict[str, Column]:
    return {
        "UPDATEDDATE": stamp(as_of),
        "UPDATEDBY": F.lit(SCD2_UPDATED_BY),
        "IS_ACTIVE": F.lit(0),
    }
