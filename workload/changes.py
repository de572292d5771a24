"""Edges to ids, versioned changes, partial updates, emptied queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes as c
from workload import roles
from workload.registry import query, text


@query(
    "resolve_edges",
    """WITH ids AS (SELECT l_orderkey, l_linenumber, 'id-' || max(l_partkey) AS id
                 FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT CAST(l.l_orderkey AS VARCHAR) AS pipeline_id,
           CAST(l.l_linenumber AS VARCHAR) AS source,
           CAST(l.l_linenumber + 1 AS VARCHAR) AS destination,
           a.id AS source_id, b.id AS destination_id, b.id IS NOT NULL AS resolved
    FROM lineitem l
    JOIN ids a ON a.l_orderkey = l.l_orderkey AND a.l_linenumber = l.l_linenumber
    LEFT JOIN ids b ON b.l_orderkey = l.l_orderkey AND b.l_linenumber = l.l_linenumber + 1""",
)
def resolve_edges(t):
    nodes = t.lineitem.select(
        text("l_orderkey").alias("pipeline_id"),
        text("l_linenumber").alias("name"),
        F.col("l_partkey").alias("pos"),
        F.concat(F.lit("id-"), "l_partkey").alias("id"),
    )
    edges = roles.edges(t).select("pipeline_id", "source", "destination")
    return c.look_up_edges(edges, nodes)


def versioned(t):
    """Customers at version 0; each order asks for a change. Every other new order creates."""
    current = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.lit(0).cast("bigint").alias("version"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    creates = (F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0)
    op = (
        F.when(F.col("o_orderstatus") == "P", "delete")
        .when(creates, "create")
        .otherwise("update")
    )
    changes = t.orders.select(
        (F.col("o_custkey") + F.when(creates, 1_000_000_000).otherwise(0)).alias("id"),
        F.col("o_orderkey").alias("seq"),
        op.alias("op"),
        (F.col("o_orderkey") % 3).alias("sent_version"),
        F.concat(F.lit("order-"), "o_orderkey").alias("name"),
        F.col("o_orderpriority").alias("segment"),
    )
    return current, changes


VERSIONED_SQL = """changes AS (
  SELECT o_custkey + CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 1000000000 ELSE 0
           END AS id, o_orderkey AS seq,
         CASE WHEN o_orderstatus = 'P' THEN 'delete'
              WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'create' ELSE 'update' END AS op,
         o_orderkey % 3 AS sent_version, 'order-' || o_orderkey AS name,
         o_orderpriority AS segment
  FROM orders),
judged AS (
  SELECT x.*, row_number() OVER (PARTITION BY id ORDER BY seq) = 1
         AND CASE WHEN op = 'create' THEN c_custkey IS NULL
                  ELSE c_custkey IS NOT NULL AND sent_version = 0 END AS accepted
  FROM changes x LEFT JOIN customer ON c_custkey = id)"""


@query(
    "versioned_apply",
    f"""WITH {VERSIONED_SQL}
    SELECT c_custkey AS id, CAST(0 AS BIGINT) AS version, c_name AS name, c_mktsegment AS segment
    FROM customer WHERE c_custkey NOT IN (SELECT id FROM judged WHERE accepted)
    UNION ALL
    SELECT id, CASE WHEN op = 'create' THEN 0 ELSE 1 END, name, segment
    FROM judged WHERE accepted AND op <> 'delete'""",
)
def versioned_apply(t):
    return c.apply_changes(*versioned(t))[0]


@query(
    "versioned_conflicts",
    f"""WITH {VERSIONED_SQL}
    SELECT id, seq, op, sent_version, name, segment FROM judged WHERE NOT accepted""",
)
def versioned_conflicts(t):
    return c.apply_changes(*versioned(t))[1]


CHAIN_SQL = """WITH RECURSIVE changes AS (
      SELECT o_custkey % 50 AS id, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS k,
             o_orderkey AS seq, CASE WHEN o_orderkey % 11 = 0 THEN 'create' WHEN o_orderkey % 13 = 0 THEN 'delete' ELSE 'update' END AS op,
             o_orderkey % 3 AS sent_version, 'order-' || o_orderkey AS name
      FROM orders),
    steps AS (
      SELECT DISTINCT id, 0::BIGINT AS k, CASE WHEN id % 2 = 0 THEN 0 ELSE -1 END::BIGINT AS state,
             CASE WHEN id % 2 = 0 THEN 'start-' || id END AS name, false AS accepted, NULL::BIGINT AS seq FROM changes
      UNION ALL
      SELECT c.id, c.k,
             CASE WHEN NOT a THEN s.state WHEN op = 'create' THEN 0 WHEN op = 'delete' THEN -1 ELSE s.state + 1 END,
             CASE WHEN a THEN c.name ELSE s.name END, a, c.seq
      FROM steps s JOIN (SELECT *, NULL AS x FROM changes) c ON c.id = s.id AND c.k = s.k + 1,
           LATERAL (SELECT CASE WHEN c.op = 'create' THEN s.state = -1 ELSE s.state >= 0 AND s.state = c.sent_version END AS a))"""


def _chains(t):
    """Fifty keys, half of them there, with hundreds of changes each; sent versions are 0 to 2."""
    key = (F.col("o_custkey") % 50).alias("id")
    op = F.when(F.col("o_orderkey") % 11 == 0, "create").when(F.col("o_orderkey") % 13 == 0, "delete").otherwise("update")
    changes = t.orders.select(
        key, F.col("o_orderkey").alias("seq"), op.alias("op"), (F.col("o_orderkey") % 3).alias("sent_version"), F.concat(F.lit("order-"), "o_orderkey").alias("name")
    )
    current = t.orders.select(key).distinct().where("id % 2 = 0").select("id", F.lit(0).cast("bigint").alias("version"), F.concat(F.lit("start-"), "id").alias("name"))
    return c.apply_changes(current, changes, rule="sequence")


@query(
    "versioned_chain",
    CHAIN_SQL + """
    SELECT id, state AS version, name FROM steps s
    WHERE k = (SELECT max(k) FROM changes x WHERE x.id = s.id) AND state >= 0""",
)
def versioned_chain(t):
    return _chains(t)[0]


@query(
    "versioned_chain_conflicts",
    CHAIN_SQL + """
    SELECT c.id, c.seq, op, sent_version, c.name FROM changes c JOIN steps s ON s.id = c.id AND s.k = c.k WHERE NOT s.accepted""",
)
def versioned_chain_conflicts(t):
    return _chains(t)[1]


@query(
    "patch_rows",
    """WITH latest AS (
      SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS p,
             arg_max(o_totalprice, o_orderkey) AS price
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, c_name,
           CASE WHEN price > 200000 THEN price ELSE c_acctbal END AS c_acctbal,
           CASE WHEN p LIKE '5%' THEN c_mktsegment ELSE coalesce(p, c_mktsegment) END
             AS c_mktsegment
    FROM customer LEFT JOIN latest ON o_custkey = c_custkey""",
)
def patch_rows(t):
    latest = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max_by(F.struct("o_orderpriority", "o_totalprice"), "o_orderkey").alias("o"))
        .select(
            "c_custkey",
            F.when(F.col("o.o_orderpriority").like("5%"), "  ")
            .otherwise(F.col("o.o_orderpriority"))
            .alias("c_mktsegment"),
            F.when(F.col("o.o_totalprice") > 200000, F.col("o.o_totalprice")).alias("c_acctbal"),
        )
    )
    current = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return c.patch(current, latest, ["c_mktsegment", "c_acctbal"], key="c_custkey")


@query(
    "empty_queue",
    f"""WITH {roles.QUEUE_SQL}
    SELECT connection_id, count(*) AS dropped_count, CAST(sum(size_bytes) AS BIGINT) AS dropped_bytes
    FROM queue WHERE connection_id IN ('3', '7', '11') GROUP BY connection_id""",
)
def empty_queue(t):
    return c.empty_queue(roles.queue(t), ["3", "7", "11"])[1]


@query(
    "empty_queue_kept",
    f"""WITH {roles.QUEUE_SQL}
    SELECT connection_id, flowfile_id, size_bytes, ts FROM queue WHERE connection_id NOT IN (
      SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 5000)""",
)
def empty_queue_kept(t):
    ids = t.supplier.where("s_acctbal < 5000").select(text("s_suppkey").alias("connection_id"))
    return c.empty_queue(roles.queue(t), ids)[0]
