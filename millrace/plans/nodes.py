"""What each processor type does: one function from rows to relationships.

A function takes (rows, properties, environment) and returns a dict from
relationship to rows. ``register`` adds a type or replaces one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import sources
from millrace.operators import records, routing
from millrace.streaming import wait_notify_stream


@dataclass
class Environment:
    """What a node may use besides its rows."""

    spark: SparkSession
    node: str
    checkpoint: str | None = None
    trigger: Mapping | None = None
    started: list[StreamingQuery] | None = None
    observations: dict | None = None
    # The number of a stream's batch that is run as frames.
    batch: int | None = None

    @property
    def streaming(self) -> bool:
        return self.started is not None


Node = Callable[[DataFrame | None, Mapping[str, str], Environment], dict[str, DataFrame]]
_NODES: dict[str, Node] = {}


def register(type_name: str, node: Node) -> None:
    """Make a processor type known by its short name."""
    _NODES[type_name] = node


def lookup(type_name: str) -> Node:
    try:
        return _NODES[type_name]
    except KeyError:
        raise ValueError(f"no processor type {type_name!r} is registered") from None


def _node(*type_names: str):
    def add(function: Node) -> Node:
        for name in type_names:
            register(name, function)
        return function

    return add


def prefixed(props: Mapping[str, str], prefix: str) -> dict[str, str]:
    """Properties such as ``route.errors``, without the prefix."""
    start = prefix + "."
    return {k[len(start):]: v for k, v in props.items() if k.startswith(start)}


def _list(text: str | None) -> list[str]:
    return [item.strip() for item in (text or "").split(",") if item.strip()]


@_node("GetFile")
def get_file(rows, props, env):
    read = sources.read_stream if env.streaming else sources.read_files
    options, fmt = prefixed(props, "option"), props.get("format", "parquet")
    if env.streaming:
        options["path"] = props["path"]
        return {"success": read(env.spark, fmt, props.get("schema"), **options)}
    return {"success": read(env.spark, props["path"], fmt, props.get("schema"), **options)}


@_node("GenerateFlowFile")
def generate_flowfile(rows, props, env):
    return {"success": sources.generate(env.spark, int(props["rows"]), prefixed(props, "column"))}


@_node("ExecuteSQL")
def execute_sql(rows, props, env):
    _batch_only(env, "ExecuteSQL")
    options, partition = prefixed(props, "option"), None
    if "partition.column" in props:
        bounds = [int(props[f"partition.{name}"]) for name in ("lower", "upper", "count")]
        partition = (props["partition.column"], *bounds)
    return {"success": sources.read_sql(env.spark, props["query"], props.get("url"), partition, **options)}


@_node("ConsumeKafka")
def consume_topic(rows, props, env):
    options, fmt = prefixed(props, "option"), props.get("format", "kafka")
    if env.streaming:
        return {"success": sources.read_stream(env.spark, fmt, props.get("schema"), **options)}
    reader = env.spark.read.format(fmt).options(**options)
    return {"success": (reader.schema(props["schema"]) if props.get("schema") else reader).load()}


@_node("ConvertRecord")
def convert_record(rows, props, env):
    return records.convert_records(
        rows, props["column"], props["from"], props["to"], props["schema"], prefixed(props, "read"), prefixed(props, "write")
    )


@_node("UpdateRecord")
def update_record(rows, props, env):
    return {"success": records.update_record(rows, prefixed(props, "field"))}


@_node("UpdateAttribute")
def update_attribute(rows, props, env):
    column = props.get("column", "attributes")
    if column not in rows.columns:
        rows = rows.withColumn(column, F.create_map().cast("map<string,string>"))
    return {"success": records.update_attributes(rows, prefixed(props, "attribute"), column)}


@_node("JoltTransformJSON")
def transform_json(rows, props, env):
    spec = json.loads(props["spec"])
    return records.restructure_json(rows, props["column"], spec)


@_node("ReplaceText")
def replace_text(rows, props, env):
    return {
        "success": records.replace_text(
            rows, props["column"], props["pattern"], props["replacement"]
        )
    }


@_node("SplitRecord")
def split_record(rows, props, env):
    slice_by = F.expr(props["slice_by"]) if "slice_by" in props else None
    return {
        "success": records.split_records(
            rows, _list(props["key"]), _list(props["order"]), int(props["size"]), slice_by
        )
    }


@_node("QueryRecord")
def query_record(rows, props, env):
    queries = prefixed(props, "query")
    return {name: records.query_record(rows, sql) for name, sql in queries.items()}


@_node("RouteOnAttribute")
def route_on_attribute(rows, props, env):
    return routing.route_on_attribute(rows, prefixed(props, "route"), props.get("mode", "all"))


@_node("RouteOnContent")
def route_on_content(rows, props, env):
    return routing.route_on_content(
        rows, props["column"], prefixed(props, "route"), props.get("mode", "all")
    )


@_node("LogAttribute")
def log_attribute(rows, props, env):
    metrics = prefixed(props, "metric") or {"rows": "count(*)"}
    if env.streaming:
        exprs = [F.expr(e).alias(name) for name, e in metrics.items()]
        return {"success": rows.observe(env.node, *exprs)}
    measured, observation = routing.log_attributes(rows, env.node, metrics)
    env.observations[env.node] = observation
    return {"success": measured}


@_node("Notify")
def notify(rows, props, env):
    signal = F.expr(props.get("count", "1")).cast("bigint").alias("signal")
    time = [props["time"]] if "time" in props else []
    return {"success": rows.select(props["key"], *time, signal)}


@_node("Wait")
def wait(rows, props, env):
    """Rows with a ``signal`` come from a Notify node; the others wait.

    A stream needs the ``time`` column and a ``timeout`` in seconds.
    """
    if env.streaming:
        outcomes = wait_notify_stream(
            rows,
            props["key"],
            int(props["target"]),
            int(props["timeout"]),
            F.col("signal"),
            props["time"],
            props.get("watermark", "1 hour"),
        ).drop("signal")
        return {
            name: outcomes.where(F.col("outcome") == name).drop("outcome")
            for name in ("released", "expired")
        }
    signals = rows.where(F.col("signal").isNotNull())
    waiting = rows.where(F.col("signal").isNull()).drop("signal")
    return routing.wait_notify(waiting, signals, props["key"], int(props["target"]), "signal")


def _batch_only(env, kind):
    if env.streaming:
        raise ValueError(f"{kind} reads or writes a table once; it has no streaming form")


def _start(rows, fmt, env, **options):
    env.started.append(
        sources.write_stream(
            rows, fmt, f"{env.checkpoint}/{env.node}", env.trigger, name=env.node, **options
        )
    )
    return {}


@_node("PutFile")
def put_file(rows, props, env):
    fmt, options = props.get("format", "parquet"), prefixed(props, "option")
    if env.streaming:
        if props.get("mode", "append") != "append":
            raise ValueError("a stream of files can only be appended to")
        if props.get("max_records_per_file"):
            options["maxRecordsPerFile"] = props["max_records_per_file"]
        return _start(rows, fmt, env, path=props["path"], partition_by=_list(props.get("partition_by")), **options)
    path, mode = props["path"], props.get("mode", "error")
    if env.batch is not None:
        # A batch that is run again replaces what it wrote.
        path, mode = f"{path}/batch={env.batch}", "overwrite"
    sources.write_files(
        rows,
        path,
        fmt,
        _list(props.get("partition_by")),
        int(props.get("max_records_per_file", 0)),
        mode,
        **options,
    )
    if env.batch is not None:
        return {"success": rows}
    return {"success": sources.read_files(env.spark, props["path"], fmt, rows.schema, **options)}


@_node("PutDatabaseRecord")
def put_database_record(rows, props, env):
    if env.streaming:
        if "url" in props:
            raise ValueError("a stream is written to a catalog table, not to a database")
        return _start(rows, props.get("format", "parquet"), env, table=props["table"])
    sources.write_records(
        rows,
        props["table"],
        props.get("mode", "append"),
        props.get("url"),
        int(props.get("batch_size", 10_000)),
        props.get("path"),
        **prefixed(props, "option"),
    )
    return {"success": rows if "url" in props else env.spark.table(props["table"])}


@_node("PutSQL")
def put_sql(rows, props, env):
    """INSERT appends rows; UPDATE changes a table with a version by ``apply_changes``.

    For an update the rows are changes with ``key``, seq, op, sent_version and the fields;
    ``rule`` is ``first`` or ``sequence``, and changes that conflict go to ``failure``.
    """
    _batch_only(env, "PutSQL")
    statement = props.get("statement", "insert").lower()
    if statement == "insert":
        sources.insert_into(rows, props["table"])
        return {"success": env.spark.table(props["table"])}
    if statement != "update":
        raise ValueError("statement is 'insert' or 'update'")
    conflicts = sources.update_table(rows, props["table"], props.get("key", "id"), props.get("rule", "first"))
    return {"success": env.spark.table(props["table"]), "failure": conflicts}


@_node("PublishKafka")
def publish_topic(rows, props, env):
    fmt, options = props.get("format", "kafka"), prefixed(props, "option")
    if env.streaming:
        return _start(rows, fmt, env, **options)
    rows.write.format(fmt).options(**options).mode("append").save()
    return {"success": rows}
