"""Trees and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import graph
from workload import roles
from workload.registry import query


@query(
    "group_subtree",
    f"""WITH RECURSIVE {roles.GROUPS_SQL}, tree AS (
      SELECT group_id, parent_id, name, 0 AS depth FROM grp WHERE group_id = 'r1'
      UNION ALL
      SELECT g.group_id, g.parent_id, g.name, depth + 1 FROM grp g
      JOIN tree ON g.parent_id = tree.group_id)
    SELECT * FROM tree""",
)
def group_subtree(t):
    return graph.subtree(roles.groups(t), "r1")


ROLLUP_SQL = f"""WITH RECURSIVE {roles.GROUPS_SQL}, measures AS (
      SELECT 'c' || c_custkey AS group_id, 1 AS customers,
             CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer
      UNION ALL
      SELECT 'n' || s_nationkey, 0, CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier),
    up AS (
      SELECT group_id AS ancestor, group_id AS member FROM grp
      UNION ALL
      SELECT g.parent_id, member FROM up JOIN grp g ON g.group_id = ancestor
      WHERE g.parent_id IS NOT NULL)
    SELECT ancestor AS group_id, CAST(coalesce(sum(customers), 0) AS BIGINT) AS customers,
           CAST(coalesce(sum(cents), 0) AS BIGINT) AS cents
    FROM up LEFT JOIN measures m ON m.group_id = member GROUP BY ancestor"""


def _measures(t):
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").alias("cents")
    return t.customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("group_id"),
        F.lit(1).cast("bigint").alias("customers"),
        cents("c_acctbal"),
    ).unionByName(
        t.supplier.select(
            F.concat(F.lit("n"), "s_nationkey").alias("group_id"),
            F.lit(0).cast("bigint").alias("customers"),
            cents("s_acctbal"),
        )
    )


@query("group_rollup", ROLLUP_SQL)
def group_rollup(t):
    return graph.rollup(roles.groups(t), _measures(t), ["customers", "cents"])


SUBTREE_SQL = f"""WITH RECURSIVE {roles.GROUPS_SQL}, tree AS (
      SELECT group_id, parent_id, name, 0 AS depth FROM grp WHERE group_id = 'r1'
      UNION ALL
      SELECT g.group_id, g.parent_id, g.name, depth + 1 FROM grp g
      JOIN tree ON g.parent_id = tree.group_id)
    SELECT * FROM tree"""


@query("subtree_intervals", SUBTREE_SQL)
def subtree_intervals(t):
    return graph.subtree_of(graph.interval_labels(roles.groups(t)), "r1")


@query("rollup_intervals", ROLLUP_SQL)
def rollup_intervals(t):
    return graph.rollup_of(graph.interval_labels(roles.groups(t)), _measures(t), ["customers", "cents"])


@query(
    "lineage_flowfile",
    f"""WITH {roles.PROVENANCE_SQL}, nodes AS (
      SELECT *, lead(event_id) OVER (PARTITION BY flowfile_uuid ORDER BY ts, event_id) AS to_event
      FROM provenance
      WHERE flowfile_uuid = (SELECT flowfile_uuid FROM provenance WHERE event_id = 77))
    SELECT flowfile_uuid, event_id AS from_event, to_event FROM nodes WHERE to_event IS NOT NULL""",
)
def lineage_flowfile(t):
    return graph.flowfile_lineage(roles.provenance(t), 77)[1]


@query(
    "lineage_flowfile_nodes",
    f"""WITH {roles.PROVENANCE_SQL} SELECT * FROM provenance
    WHERE flowfile_uuid = (SELECT flowfile_uuid FROM provenance WHERE event_id = 77)""",
)
def lineage_flowfile_nodes(t):
    return graph.flowfile_lineage(roles.provenance(t), 77)[0]


def _derivations(t):
    """Each later turn derives from the turn before it."""
    node = lambda turn: F.concat("conv_id", F.lit("-"), turn)
    turns = t.conversations.select("conv_id", "turn")
    edges = turns.where("turn > 0").select(
        node(F.col("turn") - 1).alias("src"), node("turn").alias("dst")
    )
    return edges, turns.select("turn", node("turn").alias("seed"))


DERIVATIONS_SQL = """edges AS (
  SELECT conv_id || '-' || (turn - 1) AS src, conv_id || '-' || turn AS dst
  FROM conversations WHERE turn > 0),
seeds AS (SELECT DISTINCT conv_id || '-' || turn AS seed, turn FROM conversations)"""


@query(
    "lineage_closure",
    f"""WITH RECURSIVE {DERIVATIONS_SQL}, reached AS (
      SELECT seed, seed AS node, 0 AS depth FROM seeds WHERE turn = 0
      UNION SELECT seed, dst, depth + 1 FROM reached JOIN edges ON src = node)
    SELECT * FROM reached""",
)
def lineage_closure(t):
    edges, seeds = _derivations(t)
    return graph.lineage_closure(edges, seeds.where("turn = 0"), "down")


@query(
    "lineage_closure_up",
    f"""WITH RECURSIVE {DERIVATIONS_SQL}, reached AS (
      SELECT seed, seed AS node, 0 AS depth FROM seeds
      UNION SELECT seed, src, depth + 1 FROM reached JOIN edges ON dst = node)
    SELECT * FROM reached""",
)
def lineage_closure_up(t):
    edges, seeds = _derivations(t)
    return graph.lineage_closure(edges, seeds, "up")
