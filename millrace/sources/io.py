"""Read and write files, tables, databases and topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.changes import apply_changes
from millrace.session import scratch_path

FILE_FORMATS = ("parquet", "orc", "csv", "json", "xml", "text", "binaryFile")
_NEEDS_SCHEMA = ("csv", "json", "xml")


def read_files(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema=None, **options
) -> DataFrame:
    """Read files. Text formats need a schema, so that no extra pass infers one."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"format is one of {', '.join(FILE_FORMATS)}")
    if fmt in _NEEDS_SCHEMA and schema is None:
        raise ValueError(f"pass a schema for {fmt}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def generate(spark: SparkSession, n: int, columns: Mapping[str, Column | str]) -> DataFrame:
    """``n`` rows with an ``id`` from 0 and deterministic expressions of it."""
    exprs = [
        (F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in columns.items()
    ]
    return spark.range(n).select("id", *exprs)


def read_sql(
    spark: SparkSession,
    query: str,
    url: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    **options,
) -> DataFrame:
    """Query a database over JDBC, or the tables of the session catalog without a ``url``.

    ``partition`` is (column, lower bound, upper bound, partitions): the database
    is then read by that many tasks. The bounds only share out the rows; rows
    beyond them are read too.
    """
    if url is None:
        return spark.sql(query)
    reader = spark.read.format("jdbc").options(url=url, **options)
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, parts = partition
    return (
        reader.option("dbtable", f"({query}) q")
        .options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
        .load()
    )


def read_stream(spark: SparkSession, fmt: str, schema=None, **options) -> DataFrame:
    """An unbounded source: files, a topic or a rate source.

    ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` in the options caps what one
    micro-batch takes in; the rest waits for the next one.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    path = options.pop("path", None)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    mode: str = "error",
    **options,
) -> str:
    """Write files, in one folder for each value of ``partition_by``; returns the path.

    Rows of one value are brought together first, so that not every task writes to
    every folder; a value with very many rows is split over several tasks again.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode).options(**options)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_records(
    df: DataFrame,
    table: str,
    mode: str = "append",
    url: str | None = None,
    batch_size: int = 10_000,
    path: str | None = None,
    **options,
) -> None:
    """Write to a database table over JDBC, or to a catalog table without a ``url``."""
    if url is not None:
        df.write.format("jdbc").mode(mode).options(
            url=url, dbtable=table, batchsize=batch_size, **options
        ).save()
        return
    writer = df.write.mode(mode).options(**options)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def insert_into(df: DataFrame, table: str) -> None:
    """Append to an existing catalog table, columns matched by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table)


def update_table(changes: DataFrame, table: str, key: str = "id", rule: str = "first") -> DataFrame:
    """Apply changes to a catalog table with a version column; returns those that conflict.

    The new table and the conflicts are written to the shared folder first, so a run that
    breaks off there has changed nothing, and the table's own rows are read before they go.
    """
    spark = changes.sparkSession
    kept = []
    for df, name in zip(apply_changes(spark.table(table), changes, key, rule), ("updated", "conflicts"), strict=True):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        kept.append(spark.read.schema(df.schema).parquet(path))
    kept[0].select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    return kept[1]


def write_stream(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    mode: str = "append",
    name: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    **options,
) -> StreamingQuery:
    """Start a streaming sink. Without a trigger it takes what is there and stops.

    With ``table`` the rows are appended to a catalog table.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(table) if table else writer.start()
