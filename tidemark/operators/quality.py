"""Key, reference and parse checks."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stamp
from ..schemas import CORRUPT


class Split(NamedTuple):
    good: DataFrame
    bad: DataFrame


def valid_key(df: DataFrame, *key: str) -> DataFrame:
    """Rows whose key columns are present, not blank and not zero."""

    def usable(name: str) -> Column:
        value = F.col(name)
        if df.schema[name].dataType.typeName() == "string":
            return value.isNotNull() & (F.trim(value) != "") & (value != "0")
        return value.isNotNull() & (value != 0)

    return df.filter(reduce(lambda a, b: a & b, map(usable, key)))


def has_values(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which all named columns are present."""
    return df.dropna(how="any", subset=list(names)) if names else df


def split_corrupt(df: DataFrame, key: str | list[str], as_of: object = None) -> Split:
    """Parsed rows without the corrupt column, and (key, record, time) of the others."""
    keys = [key] if isinstance(key, str) else key
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(
        *keys, CORRUPT, stamp(as_of).alias("error_time")
    )
    return Split(df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad)
