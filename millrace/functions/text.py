"""Text clean-up, names, sizes and periods. Plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank at either end of an argument.
BLANKS = " \n\r\t\x0b\x00"

# 1024-based size units.
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}

# Seconds in a period unit.
PERIOD_UNITS = {
    "ms": "0.001", "milli": "0.001", "millis": "0.001",
    "s": "1", "sec": "1", "secs": "1", "second": "1", "seconds": "1",
    "m": "60", "min": "60", "mins": "60", "minute": "60", "minutes": "60",
    "h": "3600", "hr": "3600", "hrs": "3600", "hour": "3600", "hours": "3600",
    "d": "86400", "day": "86400", "days": "86400",
    "w": "604800", "wk": "604800", "wks": "604800", "week": "604800", "weeks": "604800",
}


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column | str) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(_strip(F.col(text) if isinstance(text, str) else text), F.lit(""))


def split_list(text: Column | str, drop_blank: bool = False) -> Column:
    """Items of a comma list, each trimmed; blank items stay unless ``drop_blank``."""
    items = F.transform(F.split(blank_to_null(text), ","), _strip)
    return F.filter(items, lambda item: item != "") if drop_blank else items


def short_type_name(type_name: Column | str) -> Column:
    """The part after the last dot, or the whole type where that part is empty."""
    whole = F.col(type_name) if isinstance(type_name, str) else type_name
    last = F.substring_index(whole, ".", -1)
    return F.when(last == "", whole).otherwise(last)


def _amount_times_unit(text: Column, pattern: str, unit_factor: Column) -> Column:
    amount = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.try_multiply(amount.try_cast("decimal(28,6)"), unit_factor).try_cast("bigint")


def size_bytes(text: Column | str) -> Column:
    """Bytes of a size such as ``1 GB`` (1024-based); null for anything else."""
    whole = F.col(text) if isinstance(text, str) else text
    pattern = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?B)\s*$"
    unit = F.regexp_extract(whole, pattern, 2)
    factor = F.lit(None).cast("bigint")
    for name, value in SIZE_UNITS.items():
        factor = F.when(unit == name, F.lit(value).cast("bigint")).otherwise(factor)
    return _amount_times_unit(whole, pattern, factor)


def period_seconds(text: Column | str) -> Column:
    """Whole seconds of a period such as ``5 min``; null for anything else (cron included)."""
    whole = F.col(text) if isinstance(text, str) else text
    pattern = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$"
    unit = F.lower(F.regexp_extract(whole, pattern, 2))
    factors = F.create_map(*[F.lit(x) for pair in PERIOD_UNITS.items() for x in pair])
    return _amount_times_unit(
        whole, pattern, F.try_element_at(factors, unit).try_cast("decimal(10,3)")
    )
