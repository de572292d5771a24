"""Whole pipelines, from the builder and from JSON."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace import scratch_path
from millrace.plans import Pipeline, register
from workload.changes import VERSIONED_SQL, versioned
from workload.registry import query


@query(
    "flow_csv_ingest",
    """SELECT day, event_type, count(*) AS n, max(level) AS top_level,
           CAST(sum(cents) AS BIGINT) AS cents
    FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
                 CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS level,
                 CAST(round(value * 100) AS BIGINT) AS cents
          FROM events WHERE event_type <> 'error')
    GROUP BY day, event_type""",
)
def flow_csv_ingest(t):
    """Read events, set errors aside, add fields, aggregate in SQL, write files."""
    target = scratch_path(t.spark, "daily")
    flow = (
        Pipeline.create("Daily totals")
        .with_parameter_context("ingest", {"source": t.path("events"), "least": "50"})
        .with_controller_service("columnar", "FileOptions", {"format": "parquet"})
        .add_processor("fetch", "org.example.GetFile", {"path": "#{source}", "reader": "columnar"})
        .add_processor("route", "org.example.RouteOnAttribute", {"route.errors": "event_type = 'error'"},
                       auto_terminated=["errors"])
        .add_processor("fields", "org.example.UpdateRecord", {
            "field.day": "date_format(ts, 'yyyy-MM-dd')",
            "field.level": "CASE WHEN value >= #{least} THEN 'high' ELSE 'low' END",
            "field.cents": "CAST(round(value * 100) AS BIGINT)",
        })
        .add_processor("totals", "org.example.QueryRecord", {
            "query.daily": """SELECT day, event_type, count(*) AS n, max(level) AS top_level,
                              sum(cents) AS cents FROM {records} GROUP BY day, event_type"""})
        .add_processor("store", "org.example.PutFile", {"path": target, "writer": "columnar"})
        .connect("fetch", "route")
        .connect("route", "fields", ["unmatched"])
        .connect("fields", "totals")
        .connect("totals", "store", ["daily"])
        .build()
    )
    return flow.run(t.spark)["store"]["success"]


def _tag(rows, props, env):
    """A processor type of our own."""
    return {"success": rows.withColumn("tag", F.lit(props["tag"]))}


@query(
    "flow_from_json",
    """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'open' END
             AS tag FROM orders""",
)
def flow_from_json(t):
    register("Tag", _tag)
    definition = {
        "name": "Tag orders",
        "processors": [
            {"name": "orders", "type": "org.example.GetFile", "properties": {"path": t.path("orders")}},
            {
                "type": "org.example.RouteOnAttribute",
                "properties": {"mode": "first", "route.done": "o_orderstatus = 'F'"},
            },
            {"name": "done", "type": "Tag", "properties": {"tag": "#{finished}"}},
            {"name": "open", "type": "Tag", "properties": {"tag": "open"}},
            {
                "name": "merge",
                "type": "org.example.QueryRecord",
                "properties": {"query.success": "SELECT o_orderkey, o_orderstatus, tag FROM {records}"},
            },
        ],
        "connections": [
            {"source": "orders", "destination": "RouteOnAttribute"},
            {"source": "RouteOnAttribute", "destination": "done", "relationships": ["done"]},
            {"source": "RouteOnAttribute", "destination": "open", "relationships": ["unmatched"]},
            {"source": "done", "destination": "merge"},
            {"source": "open", "destination": "merge"},
        ],
        "parameterContexts": [{"name": "tags", "parameters": {"finished": "done"}}],
    }
    flow = Pipeline.from_json(json.dumps(definition))
    return flow.run(t.spark)["merge"]["success"]


@query(
    "auto_terminate",
    """SELECT 'kept' AS relationship, event_id FROM events WHERE event_type = 'click'""",
)
def auto_terminate(t):
    flow = (
        Pipeline.create("drop the rest")
        .add_processor(
            "route", "RouteOnAttribute", {"route.kept": "event_type = 'click'"},
            auto_terminated=["unmatched"],
        )
        .build()
    )
    routes = flow.run(t.spark, {"route": t.events})["route"]
    frames = [df.select(F.lit(name).alias("relationship"), "event_id") for name, df in routes.items()]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


@query(
    "flow_ports",
    """SELECT 'large' AS port, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_totalprice > 200000
    UNION ALL SELECT 'other', o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) FROM orders WHERE NOT o_totalprice > 200000""",
)
def flow_ports(t):
    """Rows come in by a port and leave by two; what both need is written once."""
    flow = (
        Pipeline.create("prices")
        .with_input_port("orders")
        .with_output_port("large")
        .with_output_port("other")
        .add_processor("price", "UpdateRecord", {"field.cents": "CAST(round(o_totalprice * 100) AS BIGINT)"})
        .add_processor("route", "RouteOnAttribute", {"route.large": "o_totalprice > 200000"})
        .connect("orders", "price")
        .connect("price", "route")
        .connect("route", "large", ["large"])
        .connect("route", "other", ["unmatched"])
        .build()
    )
    results = flow.run(t.spark, {"orders": t.orders})
    frames = [results[port]["success"].select(F.lit(port).alias("port"), "o_orderkey", "cents") for port in ("large", "other")]
    return frames[0].union(frames[1])


@query(
    "flow_update_table",
    f"""WITH {VERSIONED_SQL}
    SELECT c_custkey AS id, CAST(0 AS BIGINT) AS version, c_name AS name, c_mktsegment AS segment
    FROM customer WHERE c_custkey NOT IN (SELECT id FROM judged WHERE accepted)
    UNION ALL
    SELECT id, CASE WHEN op = 'create' THEN 0 ELSE 1 END, name, segment
    FROM judged WHERE accepted AND op <> 'delete'""",
)
def flow_update_table(t):
    """PutSQL as an update under optimistic locking."""
    folder = scratch_path(t.spark, "versioned")
    table = f"versioned_{folder.rsplit('-', 1)[1]}"
    current, changes = versioned(t)
    current.write.option("path", folder).saveAsTable(table)
    flow = Pipeline.create("update").add_processor("put", "PutSQL", {"table": table, "statement": "update", "key": "id"}).build()
    updated = flow.run(t.spark, {"put": changes})["put"]["success"]
    rows = t.spark.read.schema(updated.schema).parquet(folder)
    t.spark.sql(f"DROP TABLE {table}")
    return rows
