"""Stamps, day differences and the open end of a version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# End of a still-valid version, time zone of the copy log.
OPEN_END = "9999-01-01 00:00:00"
LOG_ZONE = "America/New_York"


def stamp(as_of: str | datetime | None = None) -> Column:
    """Load time of a run: a given moment, or the start of the query."""
    if as_of is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(as_of))


def day_diff(end: str, start: str) -> Column:
    """Whole days from start to end; NULL while either is unknown."""
    return F.when(F.col(end).isNotNull(), F.datediff(F.col(end), F.col(start)))


def log_time(moment: Column) -> Column:
    """A moment as wall-clock time of the log zone, whatever the session zone."""
    wall_clock = F.convert_timezone(None, F.lit(LOG_ZONE), moment.cast("timestamp_ntz"))
    return wall_clock.cast("timestamp")
