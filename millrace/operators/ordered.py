"""Row numbers, next rows and running sums within a key, for keys of any size.

A window over a key puts all rows of that key in one task. Here a window covers
only one slice of a key; a small table of slices carries the numbers across.

Where the caller names no slice it is measured: rows are dealt by splitters from a sample
of (key, order), of any type, nulls and ties included, so slices are alike however the rows
lie. The dealt rows are written once to the shared folder, as their slices must not change.
``row_numbers`` counts the keys first and deals only the rows of keys that are too large for
a task; all others are numbered after one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

# Rows of one key that a task may sort. There are few keys with more: this many times fewer than rows.
TASK_ROWS = 200_000
HASHES = 1 << 14


def large_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys of ``df`` with more than TASK_ROWS rows, a null one included; None if there are none.

    Rows are counted by a few hash values of their keys; keys only where those count too many.
    """
    few = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASHES)).cast("int").alias("_hash"))
    many = [r[0] for r in few.groupBy("_hash").agg(F.count("*").alias("_rows")).where(F.col("_rows") > TASK_ROWS).select("_hash").collect()]
    if not many:
        return None
    rows = few.where(F.col("_hash").isin(many)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    found = rows.where(F.col("_rows") > TASK_ROWS).drop("_rows")
    path = scratch_path(df.sparkSession, "large-keys")
    found.write.parquet(path)
    found = df.sparkSession.read.schema(found.schema).parquet(path)
    return None if found.isEmpty() else found


def of_keys(df: DataFrame, found: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The rows of ``df`` that have (``left_semi``) or lack (``left_anti``) one of the ``large_keys``; nulls are equal."""
    names = {key: f"_large_{i}" for i, key in enumerate(keys)}
    on = [df[key].eqNullSafe(F.col(name)) for key, name in names.items()]
    return df.join(F.broadcast(found.withColumnsRenamed(names)), on, how)


def _measured(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_slice``, which never falls as the order of a key rises; ties are dealt to several slices."""
    dealt = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*keys, *order, "_tie")
    dealt = dealt.drop("_tie").withColumn("_slice", F.spark_partition_id())
    path = scratch_path(df.sparkSession, "dealt")
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def _sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | None
) -> DataFrame:
    """Add the group of each row: key and slice as one struct, which is never null.

    ``slice_by`` is a value that never falls as the first order column rises, such as the hour
    of a timestamp; one slice of a key must fit a task.
    """
    sliced = _measured(df, keys, order) if slice_by is None else df.withColumn("_slice", slice_by)
    return sliced.withColumn("_group", F.struct(F.struct(*keys).alias("key"), F.col("_slice").alias("slice"))).drop("_slice")


def _within_key():
    return Window.partitionBy("_group.key").orderBy("_group.slice")


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_number",
    slice_by: Column | None = None,
) -> DataFrame:
    """Number the rows of each key from 1 in the given order; equal ones in any order."""
    if slice_by is None:
        plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
        found = large_keys(df, keys)
        if found is None:
            return df.withColumn(name, plain)
        rest = of_keys(df, found, keys, "left_anti").withColumn(name, plain)
        return rest.unionByName(_sliced_numbers(of_keys(df, found, keys, "left_semi"), keys, order, name, None))
    return _sliced_numbers(df, keys, order, name, slice_by)


def _sliced_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slice_by: Column | None
) -> DataFrame:
    sliced = _sliced(df, keys, order, slice_by)
    earlier = _within_key().rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_group").agg(F.count("*").alias("_rows")).select(
        "_group", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    in_slice = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    return (
        sliced.withColumn("_in_slice", in_slice)
        .join(offsets, "_group")
        .withColumn(name, F.col("_offset") + F.col("_in_slice"))
        .drop("_group", "_offset", "_in_slice")
    )


def next_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "next",
    slice_by: Column | None = None,
) -> DataFrame:
    """Add ``value`` of the following row of the same key; null on the last row of a key."""
    sliced = _sliced(df, keys, order, slice_by).withColumn(
        "_value", F.struct(value.alias("value"))
    )
    firsts = sliced.groupBy("_group").agg(
        F.min_by("_value", F.struct(*order)).alias("_first")
    ).select("_group", F.lead("_first").over(_within_key()).alias("_following"))
    in_slice = F.lead("_value").over(Window.partitionBy("_group").orderBy(*order))
    return (
        sliced.withColumn("_next", in_slice)
        .join(firsts, "_group")
        .withColumn(name, F.coalesce("_next", "_following")["value"])
        .drop("_group", "_value", "_next", "_following")
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running",
    slice_by: Column | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same key up to each row; a null counts as 0."""
    sliced = _sliced(df, keys, order, slice_by).withColumn("_value", F.coalesce(value, F.lit(0)))
    earlier = _within_key().rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_group").agg(F.sum("_value").alias("_sum")).select(
        "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    up_to = Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_inside", F.sum("_value").over(up_to))
        .join(offsets, "_group")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_group", "_offset", "_inside", "_value")
    )
