"""CASE-style classification of one column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _case(branches: Iterable[tuple[Column, object]]) -> Column:
    first, *rest = branches
    start = F.when(first[0], F.lit(first[1]))
    return reduce(lambda case, b: case.when(b[0], F.lit(b[1])), rest, start)


def band(name: str, floors: Mapping[str, float], default: str) -> Column:
    """First label whose floor lies strictly below the value, else ``default``."""
    value = F.col(name)
    return _case((value > floor, label) for label, floor in floors.items()).otherwise(default)


def group_of(name: str, groups: Mapping[str, Iterable[str]], default: str) -> Column:
    """Label of the first group that lists the value; unknown and NULL give ``default``."""
    value = F.col(name)
    return _case((value.isin(*members), label) for label, members in groups.items()).otherwise(
        default
    )


def mapped(name: str, texts: Mapping[str, str]) -> Column:
    """Replacement text of the value; unknown and NULL give NULL."""
    value = F.col(name)
    return _case((value == known, text) for known, text in texts.items())


def equals_flag(name: str, wanted: str) -> Column:
    """1 when equal, 0 otherwise (also for NULL)."""
    return F.when(F.col(name) == wanted, 1).otherwise(0)
