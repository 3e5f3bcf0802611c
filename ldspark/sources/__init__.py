"""Sources: each returns a lazy DataFrame."""

from ldspark.sources.folders import load_frames, read_files
from ldspark.sources.index import read_index
from ldspark.sources.records import (
    read_csv,
    read_json_lines,
    read_kv_text,
    read_records,
    read_sequence,
)

__all__ = [
    "load_frames",
    "read_csv",
    "read_files",
    "read_index",
    "read_json_lines",
    "read_kv_text",
    "read_records",
    "read_sequence",
]
