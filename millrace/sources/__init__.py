"""Sources and sinks, batch and streaming."""

from millrace.sources.io import (
    generate,
    insert_into,
    read_files,
    read_sql,
    read_stream,
    update_table,
    write_files,
    write_records,
    write_stream,
)

__all__ = [
    "generate",
    "insert_into",
    "read_files",
    "read_sql",
    "read_stream",
    "update_table",
    "write_files",
    "write_records",
    "write_stream",
]
