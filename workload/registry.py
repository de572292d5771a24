"""The list of queries and how they find their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` is its equivalent."""

    def add(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(configure(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def text(column) -> Column:
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")
