"""Run one definition: nodes in dependency order, rows handed on as lazy DataFrames."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import replace
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import PERIOD_UNITS
from millrace.operators.params import REFERENCE
from millrace.operators.routing import fan_in
from millrace.plans.definition import DefinitionError, Pipeline, Port, Processor
from millrace.plans.nodes import Environment, lookup
from millrace.session import scratch_path
from millrace.streaming import MetricsListener

# A property of this name takes over the properties of the service it names.
SERVICE_PROPERTIES = ("reader", "writer", "service")
# Types that write, that read by themselves, and that keep state in a stream.
SINKS = ("PutFile", "PutDatabaseRecord", "PutSQL", "PublishKafka")
SOURCES = ("GetFile", "GenerateFlowFile", "ExecuteSQL", "ConsumeKafka")
STATEFUL = ("Wait", "LogAttribute")


def bound_properties(pipeline: Pipeline, processor: Processor) -> dict[str, str]:
    """Properties with services filled in and parameters of the first context substituted."""
    props: dict[str, str] = {}
    for name in SERVICE_PROPERTIES:
        if name in processor.properties:
            service = pipeline.service(processor.properties[name])
            if service is None:
                raise DefinitionError(
                    f"{processor.name!r} names no service {processor.properties[name]!r}"
                )
            props |= service.properties
    props |= {k: v for k, v in processor.properties.items() if k not in SERVICE_PROPERTIES}
    values = pipeline.contexts[0].parameters if pipeline.contexts else {}

    def value_of(match: re.Match) -> str:
        if match[1] not in values:
            raise DefinitionError(f"{processor.name!r} uses unknown parameter {match[1]!r}")
        return values[match[1]].value

    return {k: re.sub(REFERENCE, value_of, v) for k, v in props.items()}


def _ordered(pipeline: Pipeline) -> list[str]:
    """Processors and ports, each behind what leads to it."""
    issues = pipeline.issues(ports=True)
    names = {p.name for p in pipeline.processors}
    issues += [f"Port {port.name!r} has the name of a processor." for port in pipeline.ports if port.name in names]
    if issues:
        raise DefinitionError("Validation failed:\n- " + "\n- ".join(issues))
    sorter = TopologicalSorter({p.name: set() for p in [*pipeline.processors, *pipeline.ports]})
    for c in pipeline.connections:
        sorter.add(c.destination, c.source)
    try:
        return list(sorter.static_order())
    except CycleError as error:
        raise DefinitionError(f"connections form a cycle: {error.args[1]}") from None


def sinks_behind(pipeline: Pipeline) -> dict[str, set[str]]:
    """For each processor and port the sinks that its rows may reach, itself included."""
    found = {p.name: {p.name} if p.short_type in SINKS else set() for p in pipeline.processors}
    found |= {port.name: {port.name} if port.port_type == "OUTPUT" else set() for port in pipeline.ports}
    for name in reversed(_ordered(pipeline)):
        for c in pipeline.connections:
            if c.source == name:
                found[name] |= found[c.destination]
    return found


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there by all that use it."""
    path = scratch_path(df.sparkSession, re.sub(r"\W+", "-", name))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _execute(pipeline: Pipeline, inputs: Mapping[str, DataFrame], environment, share: bool = False):
    """Outputs of all nodes. With ``share`` rows that several sinks need are written once.

    Where the ways to several sinks part at a node, its rows are: those that come in, if the
    sinks are behind different relationships; those of the relationship, if it has several.
    """
    outputs: dict[str, dict[str, DataFrame]] = {}
    sinks = sinks_behind(pipeline)
    ports = {port.name: port for port in pipeline.ports}
    for name in _ordered(pipeline):
        incoming = [inputs[name]] if name in inputs else []
        for c in pipeline.connections:
            if c.destination != name:
                continue
            offered = outputs[c.source]
            # A port has one way out, whatever relationship its connection names.
            for relationship in ["success"] if c.source in ports else c.relationships:
                if relationship not in offered:
                    raise DefinitionError(f"{c.source!r} has no relationship {relationship!r}")
                incoming.append(offered[relationship])
        rows = fan_in(incoming) if incoming else None
        # The sinks behind each relationship, by connection.
        ways = [(r, c) for c in pipeline.connections if c.source == name and sinks[c.destination] for r in c.relationships]
        uses = Counter("success" if name in ports else r for r, _ in ways)
        several = share and len(set().union(*[sinks[c.destination] for _, c in ways])) > 1
        if name in ports:
            if rows is None:
                raise DefinitionError(f"port {name!r} was given no rows")
            outputs[name] = {"success": _written(rows, name) if several else rows}
            continue
        if several and len(uses) > 1 and rows is not None:
            rows = _written(rows, name)
        processor = pipeline.processor(name)
        node = lookup(processor.short_type)
        routes = node(rows, bound_properties(pipeline, processor), environment(processor))
        outputs[name] = {r: _written(df, f"{name}-{r}") if several and uses[r] > 1 else df for r, df in routes.items()}
    ended = {p.name: p.auto_terminated for p in pipeline.processors}
    return {
        name: {relationship: df for relationship, df in routes.items() if relationship not in ended.get(name, ())}
        for name, routes in outputs.items()
        if name not in ports or ports[name].port_type == "OUTPUT"
    }


def run(
    pipeline: Pipeline, spark: SparkSession, inputs: Mapping[str, DataFrame] | None = None
) -> dict[str, dict[str, DataFrame]]:
    """The rows of every node and relationship, except the auto-terminated ones.

    ``inputs`` are the rows of input ports and extra rows for nodes, by name; what reaches an
    output port is returned under its name as ``success``. Sinks write as the call runs;
    everything else stays lazy, so a branch nobody reads costs nothing. Rows that several
    sinks or output ports need are written once to the shared folder, where the ways to
    them part, and read from there.
    """
    observations: dict = {}
    return _execute(
        pipeline,
        inputs or {},
        lambda p: Environment(spark, p.name, observations=observations),
        share=True,
    )


def trigger_of(processor: Processor) -> dict:
    """The streaming trigger of a timer period; without one, what is there is taken once.

    Anything else, such as a cron expression, is an error.
    """
    period = processor.scheduling.get("schedulingPeriod") or ""
    if not period.strip():
        return {"availableNow": True}
    match = re.fullmatch(r"\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*", period)
    if not match or match[2].lower() not in PERIOD_UNITS:
        raise ValueError(f"{processor.name}: cannot read the period {period!r}")
    seconds = float(match[1]) * float(PERIOD_UNITS[match[2].lower()])
    return {"processingTime": f"{int(seconds * 1000)} milliseconds"}


def run_stream(
    pipeline: Pipeline,
    spark: SparkSession,
    inputs: Mapping[str, DataFrame] | None = None,
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    metrics: MetricsListener | None = None,
) -> list[StreamingQuery]:
    """Start the sinks of a pipeline over streaming rows; returns the running queries.

    A sink keeps its progress in its own folder under ``checkpoint`` and runs
    on its timer period, unless a ``trigger`` is passed. Several PutFile sinks behind one source
    are one query that reads it once: each batch of it goes through the pipeline, and a sink writes
    it to a folder of its own, ``batch=<number>``, so a batch that is run again replaces itself.
    Their rows have that column, too. Nodes with state need a query for each sink.

    ``metrics`` keeps what LogAttribute nodes measure, a row for each batch, node and metric.
    """
    if not checkpoint:
        raise ValueError("pass a checkpoint folder that all executors share")
    if metrics:
        spark.streams.addListener(metrics)
    sources = [p.name for p in pipeline.processors if p.short_type in SOURCES]
    sinks = [p for p in pipeline.processors if p.short_type in SINKS]
    stateless = not any(p.short_type in STATEFUL for p in pipeline.processors)
    given = {k: df for k, df in (inputs or {}).items() if df.isStreaming}
    whole = stateless and len(sinks) > 1 and all(p.short_type == "PutFile" for p in sinks)
    if whole and len(given) + len(sources) == 1:
        return [_run_batches(pipeline, spark, dict(inputs or {}), sources, sinks, checkpoint, trigger)]
    started: list[StreamingQuery] = []
    _execute(
        pipeline,
        inputs or {},
        lambda p: Environment(spark, p.name, checkpoint, trigger or trigger_of(p), started),
    )
    return started


def _run_batches(pipeline, spark, inputs, sources, sinks, checkpoint, trigger) -> StreamingQuery:
    """One query over the one streaming source, whose batches go through the pipeline as frames."""
    if sources:
        processor = pipeline.processor(sources[0])
        env = Environment(spark, processor.name, checkpoint, None, [])
        start, stream = processor.name, lookup(processor.short_type)(None, bound_properties(pipeline, processor), env)["success"]
    else:
        start, stream = next((k, df) for k, df in inputs.items() if df.isStreaming)

    def each(batch: DataFrame, number: int) -> None:
        rows = inputs | {start: batch}
        _execute(
            pipeline if not sources else _from_rows(pipeline, start),
            rows,
            lambda p: Environment(batch.sparkSession, p.name, observations={}, batch=number),
            share=True,
        )

    triggers = [trigger_of(p) for p in sinks]
    chosen = trigger or next((t for t in triggers if "processingTime" in t), triggers[0])
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/{pipeline.name}")
    return writer.queryName(pipeline.name).trigger(**chosen).start()


def _from_rows(pipeline: Pipeline, source: str) -> Pipeline:
    """The pipeline with a port in place of its source."""
    rest = tuple(p for p in pipeline.processors if p.name != source)
    return replace(pipeline, processors=rest, ports=(*pipeline.ports, Port.input(source)))
