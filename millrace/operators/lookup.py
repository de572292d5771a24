"""Joins of many rows to a table with one row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | Sequence[str] | Sequence[tuple[str, str]],
    how: str = "left",
) -> DataFrame:
    """Join ``rows`` to ``table``, which is unique by its key. ``rows`` may have hot keys.

    A table that was just aggregated by the key would be joined where it lies,
    and Spark does not split a hot key of ``rows`` there. Compared as one struct,
    the key has both sides shuffled for the join itself, so that a hot key is
    split at run time. Null keys match nothing. ``on`` has names, or pairs of a
    column of ``rows`` and one of ``table``; the key of ``table`` is not returned.
    """
    names = [on] if isinstance(on, str) else list(on)
    pairs = [(name, name) if isinstance(name, str) else name for name in names]
    table_keys = [key for _, key in pairs]
    for key in table_keys:
        table = table.where(F.col(key).isNotNull())
    found = table.select(
        F.struct(*[F.col(key).alias(f"k{i}") for i, key in enumerate(table_keys)]).alias("_key"),
        *[c for c in table.columns if c not in table_keys],
    )
    wanted = F.struct(*[rows[key].alias(f"k{i}") for i, (key, _) in enumerate(pairs)])
    return rows.join(found, wanted == found["_key"], how).drop("_key")
