"""Column-level building blocks; all of them stay inside Catalyst."""

from .classify import band, equals_flag, group_of, mapped
from .hashing import row_hash, row_hash_plain, rows_differ
from .numbers import amount_sums, amount_total, exact_avg, exact_sum, percent_of, unit_price
from .text import full_name, title_case, upper_trim
from .times import LOG_ZONE, OPEN_END, day_diff, log_time, stamp

__all__ = [
    "LOG_ZONE",
    "OPEN_END",
    "amount_sums",
    "amount_total",
    "band",
    "day_diff",
    "equals_flag",
    "exact_avg",
    "exact_sum",
    "full_name",
    "group_of",
    "log_time",
    "mapped",
    "percent_of",
    "row_hash",
    "row_hash_plain",
    "rows_differ",
    "stamp",
    "title_case",
    "unit_price",
    "upper_trim",
]
