"""Structured Streaming: dropped files and continuous upserts."""

from .drops import drop_stream, files_per_batch, land_drops
from .upserts import read_stream_state, upsert_stream

__all__ = ["drop_stream", "files_per_batch", "land_drops", "read_stream_state", "upsert_stream"]
