"""Row fingerprints and row comparison for change detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"
NULL_MARK = "\u0000"


def row_hash(*names: str) -> Column:
    """CRC-32 over the separated texts of the columns, telling NULL from every text."""
    texts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_MARK)) for n in names]
    return F.crc32(F.concat_ws(SEPARATOR, *texts))


def row_hash_plain(*names: str, separator: str | None = None) -> Column:
    """CRC-32 as commonly hand-written.

    Without a separator one NULL makes the hash NULL; with one, NULLs are skipped.
    """
    texts = [F.col(n).cast("string") for n in names]
    joined = F.concat(*texts) if separator is None else F.concat_ws(separator, *texts)
    return F.crc32(joined)


def rows_differ(left: str, right: str, names: Sequence[str]) -> Column:
    """True when any column differs between two prefixes, NULL being equal to NULL."""
    same = (F.col(f"{left}{n}").eqNullSafe(F.col(f"{right}{n}")) for n in names)
    return ~reduce(lambda a, b: a & b, same)
