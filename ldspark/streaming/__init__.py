"""Streams: the batch operators between a streaming source and sink."""

from ldspark.streaming.streams import (
    merge_documents_stream,
    print_stream,
    publish_folder,
    read_json_stream,
    read_message_files,
    read_topics,
    upsert_documents_stream,
    upsert_stream,
    write_stream,
)

__all__ = [
    "merge_documents_stream",
    "print_stream",
    "publish_folder",
    "read_json_stream",
    "read_message_files",
    "read_topics",
    "upsert_documents_stream",
    "upsert_stream",
    "write_stream",
]
