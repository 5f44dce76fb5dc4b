"""DataFrame-to-DataFrame operators."""

from .control import Copy, advance_watermarks, copy_log, failure_messages, watermark_seed
from .increment import high_water_mark, pull_increment
from .latest import keep_latest, merge_latest, merge_versions
from .quality import has_values, split_corrupt, valid_key
from .scd import scd1_upsert, scd2_changed_keys, scd2_upsert
from .skew import Side, heavy_keys, join_all

__all__ = [
    "Copy",
    "Side",
    "advance_watermarks",
    "copy_log",
    "failure_messages",
    "has_values",
    "heavy_keys",
    "high_water_mark",
    "join_all",
    "keep_latest",
    "merge_latest",
    "merge_versions",
    "pull_increment",
    "scd1_upsert",
    "scd2_changed_keys",
    "scd2_upsert",
    "split_corrupt",
    "valid_key",
    "watermark_seed",
]
