"""Column functions."""

from millrace.functions.maps import drop_blank_entries, merge_maps
from millrace.functions.text import (
    blank_to_null,
    period_seconds,
    short_type_name,
    size_bytes,
    split_list,
)

__all__ = [
    "blank_to_null",
    "drop_blank_entries",
    "merge_maps",
    "period_seconds",
    "short_type_name",
    "size_bytes",
    "split_list",
]
