"""String-to-string maps: merge with the later value winning, and clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def merge_maps(old: Column, new: Column) -> Column:
    """Entries of both maps; ``new`` wins where a key is in both. A null map counts as empty."""
    newer = F.coalesce(new, empty_map())
    kept = F.map_filter(
        F.coalesce(old, empty_map()), lambda key, _: ~F.map_contains_key(newer, key)
    )
    return F.map_concat(kept, newer)


def drop_blank_entries(entries: Column) -> Column:
    """The map without null and empty values."""
    return F.map_filter(entries, lambda _, value: value.isNotNull() & (value != ""))
