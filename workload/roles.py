"""Which given table plays which role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workload.registry import Tables, text


def provenance(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        "ts",
        F.pmod("event_id", F.lit(10)).alias("processor_id"),
        F.col("event_type").alias("component_type"),
        F.col("user_id").alias("flowfile_uuid"),
    )


PROVENANCE_SQL = """provenance AS (
  SELECT event_id, ts, event_id % 10 AS processor_id, event_type AS component_type,
         user_id AS flowfile_uuid FROM events)"""


def pipelines(t: Tables) -> DataFrame:
    return t.orders.select(
        text("o_orderkey").alias("pipeline_id"),
        F.concat(F.lit("flow-"), "o_orderkey").alias("name"),
    )


def processors(t: Tables) -> DataFrame:
    """Lines as processors; the type is empty for small parts."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    parts = t.part.select(
        "p_partkey", F.when(F.col("p_size") < 5, "").otherwise(F.col("p_type")).alias("type")
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        text("l_orderkey").alias("pipeline_id"),
        F.col("l_linenumber").alias("pos"),
        text("l_linenumber").alias("name"),
        "type",
    )


def edges(t: Tables, step: int = 1) -> DataFrame:
    """Each line leads to the line with the next number; returned lines carry no relationship."""
    relationships = F.when(F.col("l_returnflag") == "R", F.array().cast("array<string>")).otherwise(
        F.array(F.lit("success"))
    )
    other: Column = text(F.col("l_linenumber") + abs(step))
    ends = (text("l_linenumber"), other) if step > 0 else (other, text("l_linenumber"))
    return t.lineitem.select(
        text("l_orderkey").alias("pipeline_id"),
        F.col("l_linenumber").alias("pos"),
        ends[0].alias("source"),
        ends[1].alias("destination"),
        relationships.alias("relationships"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber") * 100)
        .cast("bigint")
        .alias("object_threshold"),
        F.when(F.col("l_linenumber") == 4, "1 GB").alias("size_threshold"),
    )


def services(t: Tables) -> DataFrame:
    """Each order has a service named after its priority, customers' second orders a clash."""
    return t.orders.select(
        text("o_custkey").alias("pipeline_id"),
        F.col("o_orderkey").cast("int").alias("pos"),
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("org.example."), "o_orderstatus").alias("type"),
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("properties"),
    )


def contexts(t: Tables) -> DataFrame:
    """Parts as contexts of their brand."""
    return t.part.select(
        F.col("p_brand").alias("pipeline_id"),
        F.col("p_partkey").cast("int").alias("pos"),
        F.col("p_name").alias("name"),
        F.lit("").alias("description"),
    )


def parameters(t: Tables) -> DataFrame:
    """The latest part of each (brand, type) as a parameter."""
    return (
        t.part.groupBy(F.col("p_brand").alias("context"), F.col("p_type").alias("name"))
        .agg(F.max_by(F.struct("p_name", "p_size"), "p_partkey").alias("p"))
        .select(
            "context",
            "name",
            F.col("p.p_name").alias("value"),
            (F.col("p.p_size") % 2 == 0).alias("sensitive"),
        )
    )


PARAMETERS_SQL = """params AS (
  SELECT p_brand AS context, p_type AS name, arg_max(p_name, p_partkey) AS value,
         arg_max(p_size, p_partkey) % 2 = 0 AS sensitive
  FROM part GROUP BY p_brand, p_type)"""


def groups(t: Tables) -> DataFrame:
    """Regions hold nations, nations hold customers."""
    regions = t.region.select(
        F.concat(F.lit("r"), "r_regionkey").alias("group_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("r_name").alias("name"),
    )
    nations = t.nation.select(
        F.concat(F.lit("n"), "n_nationkey").alias("group_id"),
        F.concat(F.lit("r"), "n_regionkey").alias("parent_id"),
        F.col("n_name").alias("name"),
    )
    customers = t.customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("group_id"),
        F.concat(F.lit("n"), "c_nationkey").alias("parent_id"),
        F.col("c_name").alias("name"),
    )
    return regions.unionByName(nations).unionByName(customers)


GROUPS_SQL = """grp AS (
  SELECT 'r' || r_regionkey AS group_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name
  FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer)"""


def queue(t: Tables) -> DataFrame:
    """Lines queue at their supplier; a cent is a byte."""
    return t.lineitem.select(
        text("l_suppkey").alias("connection_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("flowfile_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("size_bytes"),
        F.col("l_shipdate").alias("ts"),
    )


QUEUE_SQL = """queue AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS connection_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey AS flowfile_id,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS size_bytes, l_shipdate AS ts
  FROM lineitem)"""


def attributes(t: Tables) -> DataFrame:
    """Events with attributes."""
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        "event_id",
        "user_id",
        F.create_map(F.lit("k"), k, F.lit("type"), F.col("event_type")).alias("attributes"),
    )
