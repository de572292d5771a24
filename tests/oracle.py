"""Run queries in Spark and their SQL in DuckDB and compare rows, names and types.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type → DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millrace-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(tuple, frame.itertuples(index=False)), key=repr)


def difference(df: DataFrame, con, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"types: {ours} != {theirs}"
    left, right = _rows(df.toPandas()), _rows(relation.df())
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"values: {str(a)[:400]} != {str(b)[:400]}"
    return None if left else "no rows"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con = session(), database(folder)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = difference(df, con, oracle[name]) if name in oracle else f"{df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments[0] if arguments else "/root/testdata/sf0.01"
    sys.exit(min(main(where, arguments[1:]), 99))
