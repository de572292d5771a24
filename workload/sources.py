"""Sources and sinks: write, then read back. Output goes to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace import scratch_path, sources
from workload.registry import query, text


@query("get_file", "SELECT * FROM orders")
def get_file(t):
    return sources.read_files(t.spark, t.path("orders"), "parquet")


@query(
    "get_file_csv",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer""",
)
def get_file_csv(t):
    columns = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = sources.write_files(columns, scratch_path(t.spark, "csv"), "csv", header=True)
    return sources.read_files(t.spark, path, "csv", columns.schema, header=True)


@query(
    "generate_flowfile",
    """SELECT event_id AS id, event_id % 7 AS bucket, 'row-' || event_id AS label, event_type
    FROM events""",
)
def generate_flowfile(t):
    rows = sources.generate(
        t.spark, t.events.count(), {"bucket": "pmod(id, 7)", "label": "concat('row-', id)"}
    )
    return rows.join(t.events.select(F.col("event_id").alias("id"), "event_type"), "id")


def _table(name: str) -> str:
    return f"millrace_{name}_{uuid.uuid4().hex[:8]}"


@query(
    "execute_sql",
    """SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
)
def execute_sql(t):
    table = _table("accounts")
    sources.write_records(t.customer, table, path=scratch_path(t.spark, table))
    return sources.read_sql(
        t.spark,
        f"""SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
        FROM {table} WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
    )


@query("put_file", "SELECT event_id, user_id, event_type, value FROM events")
def put_file(t):
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    path = sources.write_files(
        rows,
        scratch_path(t.spark, "events"),
        partition_by=["event_type"],
        max_records_per_file=1_000_000,
    )
    return sources.read_files(t.spark, path)


@query("put_database_record", "SELECT * FROM supplier")
def put_database_record(t):
    table = _table("supplier")
    sources.write_records(t.supplier, table, path=scratch_path(t.spark, table))
    return t.spark.table(table)


@query(
    "put_sql",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def put_sql(t):
    table = _table("party")
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    sources.write_records(customers, table, path=scratch_path(t.spark, table))
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    sources.insert_into(suppliers, table)
    return t.spark.table(table)
