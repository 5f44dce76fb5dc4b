"""Money arithmetic that does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are split exactly into units, millionths and what a double holds beyond them.
MILLION = 1_000_000


def _parts(value: Column) -> list[Column]:
    """Whole units, whole millionths and the rest of an amount; together the amount itself.

    Sums of the first two are integers and so do not depend on the order of the rows;
    the rest of an amount with up to six decimals is 0. In ANSI mode (the default) a
    sum beyond 64 bits is an error, not a wrong number.
    """
    units = F.floor(value)
    millionths = F.rint((value - units) * MILLION)
    rest = value - (units * MILLION + millionths) / MILLION
    return [units.cast("bigint"), millionths.cast("bigint"), rest]


def amount_sums(value: str | Column, name: str) -> list[Column]:
    """Partial sums of an amount, as columns ``name``_units, _millionths and _rest."""
    parts = _parts(_column(value))
    return [F.sum(part).alias(f"{name}_{what}") for part, what in zip(parts, PARTS)]


PARTS = ("units", "millionths", "rest")


def amount_total(name: str, times: str | Column | None = None) -> Column:
    """Total of partial sums made by :func:`amount_sums`, each counted ``times`` times."""
    count = F.lit(1) if times is None else _column(times)
    return _total(*(F.sum(F.col(f"{name}_{what}") * count) for what in PARTS))


def exact_sum(value: str | Column) -> Column:
    """Sum of a double column without rounding any amount, the same for any partitioning
    as long as amounts have at most six decimals."""
    return _total(*(F.sum(part) for part in _parts(_column(value))))


def _total(units: Column, millionths: Column, rest: Column) -> Column:
    whole = units.cast("decimal(20,0)") * MILLION + millionths.cast("decimal(20,0)")
    return (whole / MILLION).cast("double") + rest


def exact_avg(value: str | Column) -> Column:
    """Exact sum over the number of non-NULL values; NULL when there are none."""
    return F.try_divide(exact_sum(value), F.count(_column(value)))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole of two aggregates; NULL when the whole is 0."""
    return F.try_divide(part * F.lit(100.0), whole)


def unit_price(total: str, quantity: str) -> Column:
    """Division of two columns; callers filter quantity 0 beforehand."""
    return F.col(total) / F.col(quantity)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
