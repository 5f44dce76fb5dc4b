"""Text standardising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(name: str) -> Column:
    """Trimmed, every space-separated word capitalised, the rest lower case."""
    return F.initcap(F.trim(F.col(name)))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def full_name(*names: str) -> Column:
    """Parts joined by one space; NULL parts are skipped, all NULL gives ''."""
    return F.concat_ws(" ", *names)


def code_breaks(name: str) -> Column:
    """Text on one line: line breaks, and the percent sign itself, as percent codes."""
    text = F.col(name)
    for plain, coded in BREAKS:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def decode_breaks(name: str) -> Column:
    text = F.col(name)
    for plain, coded in reversed(BREAKS):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


BREAKS = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))
