"""Readers and writers."""

from .files import file_row_counts, list_files, read_csv, read_json, split_drops
from .sinks import append_table, create_table, overwrite_table, quarantine, write_csv, write_json
from .tables import read_jdbc, table
from .versions import (
    current_version,
    drop_old_states,
    load_state,
    merge_parts,
    publish,
    read_current,
    read_parts,
    register_view,
    write_parts,
)

__all__ = [
    "append_table",
    "create_table",
    "current_version",
    "drop_old_states",
    "file_row_counts",
    "list_files",
    "load_state",
    "merge_parts",
    "overwrite_table",
    "publish",
    "quarantine",
    "read_csv",
    "read_current",
    "read_jdbc",
    "read_json",
    "read_parts",
    "register_view",
    "split_drops",
    "table",
    "write_csv",
    "write_json",
    "write_parts",
]
