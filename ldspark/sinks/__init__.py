"""Sinks: the only places where a plan runs."""

from ldspark.sinks.records import (
    write_csv,
    write_frames,
    write_json_index,
    write_kv_text,
    write_lines,
    write_rejects,
    write_sequence,
)

__all__ = [
    "write_csv",
    "write_frames",
    "write_json_index",
    "write_kv_text",
    "write_lines",
    "write_rejects",
    "write_sequence",
]
