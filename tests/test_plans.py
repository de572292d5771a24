"""Pipelines from the builder and from JSON, in batch and as a stream; sources and sinks."""

import json
import random
import tempfile
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import scratch_path, session, shared_dir, sources
from millrace.plans import DefinitionError, ParameterValue, Pipeline, register
from millrace.plans.run import bound_properties, trigger_of
from millrace.streaming import label_late, queue_status_stream, wait_notify_stream


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="millrace-test-")


# Definitions

def test_builder_keeps_order_and_first_match_wins():
    flow = (
        Pipeline.create("x")
        .add_processor("a", "T")
        .add_processor("a", "U")
        .with_parameter_context_values("c", {"k": ParameterValue("v", True, "d")}, "about")
        .with_controller_service("s", "Pool", {"url": "u"})
        .in_group("g")
        .build()
    )
    assert flow.processor("a").type == "T" and flow.processor("none") is None
    assert flow.context("c").parameters["k"].sensitive and flow.service("s").properties == {"url": "u"}
    assert flow.parent_group == "g"


def test_copies_leave_the_original_alone():
    a = Pipeline.create("x").add_processor("a", "T", {"k": "1", "j": "2"}).build().processor("a")
    b = a.with_properties({"k": "9"}).with_id("7")
    assert (a.properties, a.id) == ({"k": "1", "j": "2"}, None)
    assert (b.properties, b.id) == ({"k": "9", "j": "2"}, "7")


def test_parameters_of_the_first_context_in_one_pass():
    flow = (
        Pipeline.create("x")
        .with_parameter_context("one", {"x": "#{y}", "y": "2"})
        .with_parameter_context("two", {"z": "3"})
        .with_controller_service("s", "Options", {"format": "csv", "path": "/from/service"})
        .add_processor("a", "T", {"p": "#{x}-#{y}", "reader": "s", "path": "/own"})
        .add_processor("b", "T", {"p": "#{z}"})
        .add_processor("c", "T", {"reader": "none"})
        .build()
    )
    assert bound_properties(flow, flow.processor("a")) == {
        "p": "#{y}-2", "format": "csv", "path": "/own",
    }
    with pytest.raises(DefinitionError, match="unknown parameter 'z'"):
        bound_properties(flow, flow.processor("b"))
    with pytest.raises(DefinitionError, match="no service"):
        bound_properties(flow, flow.processor("c"))


def test_cycles_and_broken_definitions_do_not_run(spark):
    loop = Pipeline.create("x").add_processor("a", "T").connect("a", "a").build()
    assert loop.issues() == []
    with pytest.raises(DefinitionError, match="cycle"):
        loop.run(spark)
    with pytest.raises(DefinitionError, match="does not match any processor name"):
        Pipeline.create("x").add_processor("a", "T").connect("a", "b").build().run(spark)
    with pytest.raises(ValueError, match="no processor type"):
        Pipeline.create("x").add_processor("a", "org.example.Unheard").build().run(spark)


def test_unknown_relationship_is_refused(spark):
    flow = (
        Pipeline.create("x")
        .add_processor("a", "ReplaceText", {"column": "t", "pattern": "a", "replacement": "b"})
        .add_processor("b", "LogAttribute")
        .connect("a", "b", ["failure"])
        .build()
    )
    with pytest.raises(DefinitionError, match="no relationship 'failure'"):
        flow.run(spark, {"a": spark.range(1).select(F.lit("a").alias("t"))})


def test_every_transform_type(spark):
    """One flow through the transforms, with fan-out, fan-in and auto-termination."""
    definition = {
        "name": "all",
        "processors": [
            {"name": "make", "type": "x.GenerateFlowFile", "properties": {
                "rows": "20", "column.text": "concat('{\"a\":', id, '}')", "column.k": "pmod(id, 2)"}},
            {"type": "x.UpdateAttribute", "properties": {"attribute.kind": "concat('k', k)"}},
            {"type": "x.RouteOnAttribute", "properties": {
                "route.even": "attributes['kind'] = 'k0'", "route.all": "true"},
                "autoTerminatedRelationships": ["unmatched"]},
            {"type": "x.JoltTransformJSON", "properties": {"column": "text", "spec": json.dumps(
                [{"op": "shift", "fields": {"a:int": "b"}}])}},
            {"type": "x.ReplaceText", "properties": {
                "column": "text", "pattern": "\"b\"", "replacement": "\"c\""}},
            {"type": "x.ConvertRecord", "properties": {
                "column": "text", "from": "json", "to": "csv", "schema": "c int"}},
            {"type": "x.UpdateRecord", "properties": {"field.n": "cast(text as int)"}},
            {"type": "x.SplitRecord", "properties": {"key": "k", "order": "id", "size": "3"}},
            {"type": "x.LogAttribute", "properties": {"metric.n": "count(*)"}},
            {"type": "x.QueryRecord", "properties": {
                "query.sums": "SELECT k, batch, sum(n) AS n FROM {records} GROUP BY k, batch"}},
            {"type": "x.RouteOnContent", "properties": {"column": "text", "route.one": "1"}},
        ],
        "connections": [
            {"source": "make", "destination": "UpdateAttribute"},
            {"source": "UpdateAttribute", "destination": "RouteOnAttribute"},
            {"source": "RouteOnAttribute", "destination": "JoltTransformJSON",
             "relationships": ["all"]},
            {"source": "JoltTransformJSON", "destination": "ReplaceText"},
            {"source": "ReplaceText", "destination": "ConvertRecord"},
            {"source": "ConvertRecord", "destination": "UpdateRecord"},
            {"source": "UpdateRecord", "destination": "SplitRecord"},
            {"source": "SplitRecord", "destination": "LogAttribute"},
            {"source": "LogAttribute", "destination": "QueryRecord"},
            {"source": "LogAttribute", "destination": "RouteOnContent"},
        ],
    }
    out = Pipeline.from_json(json.dumps(definition)).run(spark)
    assert set(out["RouteOnAttribute"]) == {"even", "all"}
    assert rows(out["QueryRecord"]["sums"]) == [
        (0, 0, 6), (0, 1, 24), (0, 2, 42), (0, 3, 18), (1, 0, 9), (1, 1, 27), (1, 2, 45), (1, 3, 19),
    ]
    assert out["RouteOnContent"]["one"].count() == 11
    assert out["ConvertRecord"]["failure"].count() == 0


def test_wait_and_notify_types(spark):
    flow = (
        Pipeline.create("x")
        .add_processor("signal", "Notify", {"key": "k", "count": "n"})
        .add_processor("hold", "Wait", {"key": "k", "target": "3"})
        .connect("signal", "hold")
        .build()
    )
    signals = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, n int")
    waiting = spark.createDataFrame([("a", 1), ("b", 2)], "k string, id int")
    out = flow.run(spark, {"signal": signals, "hold": waiting})["hold"]
    assert rows(out["released"], "k", "id") == [("a", 1)]
    assert rows(out["waiting"], "k", "id") == [("b", 2)]


def test_ports_carry_rows_in_and_out(spark):
    flow = (
        Pipeline.create("x").with_input_port("in").with_output_port("out").with_output_port("none")
        .add_processor("twice", "UpdateRecord", {"field.id": "id * 2"})
        .connect("in", "twice").connect("twice", "out").connect("in", "none").build()
    )
    found = flow.run(spark, {"in": spark.range(3)})
    assert rows(found["out"]["success"]) == [(0,), (2,), (4,)] and rows(found["none"]["success"]) == [(0,), (1,), (2,)]
    assert "in" not in found
    # The rules of a definition know no ports.
    assert any("does not match" in message for message in flow.issues()) and flow.issues(ports=True) == []
    with pytest.raises(DefinitionError, match="given no rows"):
        flow.run(spark)
    with pytest.raises(DefinitionError, match="name of a processor"):
        Pipeline.create("x").with_input_port("a").add_processor("a", "UpdateRecord").build().run(spark, {"a": spark.range(1)})
    with pytest.raises(DefinitionError, match="does not match"):
        Pipeline.create("x").with_output_port("o").add_processor("a", "UpdateRecord").connect("o", "a").build().run(spark)


def test_rows_for_several_sinks_are_computed_once(spark, tmp):
    """The source is scanned once; the sinks read what was written where their ways part."""
    spark.range(100).write.parquet(f"{tmp}/in")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    register("Count", lambda df, props, env: {"success": df.mapInPandas(counted, df.schema)})
    flow = (
        Pipeline.create("x")
        .add_processor("read", "GetFile", {"path": f"{tmp}/in"})
        .add_processor("count", "Count")
        .add_processor("route", "RouteOnAttribute", {"route.small": "id < 10"})
        .add_processor("a", "PutFile", {"path": f"{tmp}/a"})
        .add_processor("b", "PutFile", {"path": f"{tmp}/b"})
        .add_processor("c", "PutFile", {"path": f"{tmp}/c"})
        .connect("read", "count").connect("count", "route")
        .connect("route", "a", ["small"]).connect("route", "b", ["unmatched"]).connect("route", "c", ["unmatched"])
        .build()
    )
    found = flow.run(spark)
    assert [spark.read.parquet(f"{tmp}/{x}").count() for x in "abc"] == [10, 90, 90]
    assert seen.value == 100
    plan = found["route"]["unmatched"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and f"{tmp}/in" not in plan


def test_update_by_definition(spark, tmp):
    table = f"t{time.time_ns()}"
    current = spark.createDataFrame([("a", 0, 1), ("b", 2, 2)], "id string, version bigint, n int")
    current.write.option("path", f"{tmp}/table").saveAsTable(table)
    asked = [("a", 1, "update", 0, 10), ("a", 2, "update", 1, 11), ("b", 1, "delete", 0, 0), ("c", 1, "create", None, 5), (None, 9, "create", None, 6)]
    given = spark.createDataFrame(asked, "id string, seq bigint, op string, sent_version bigint, n int")
    flow = Pipeline.create("x").add_processor("put", "PutSQL", {"table": table, "statement": "UPDATE", "rule": "sequence"}).build()
    found = flow.run(spark, {"put": given})["put"]
    assert rows(found["success"], "id", "version", "n") == [("a", 2, 11), ("b", 2, 2), ("c", 0, 5)]
    assert rows(found["failure"], "id", "seq") == [("b", 1), (None, 9)]
    with pytest.raises(ValueError, match="statement"):
        Pipeline.create("x").add_processor("put", "PutSQL", {"table": table, "statement": "merge"}).build().run(spark, {"put": given})
    spark.sql(f"DROP TABLE {table}")


def test_partitioned_read_is_passed_on(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(sources, "read_sql", lambda spark, query, url, partition, **options: asked.update(url=url, partition=partition, **options) or spark.range(1))
    props = {"query": "SELECT 1", "url": "jdbc:x", "partition.column": "id", "partition.lower": "1", "partition.upper": "900", "partition.count": "16", "option.fetchsize": "50"}
    Pipeline.create("x").add_processor("sql", "ExecuteSQL", props).build().run(spark)
    assert asked == {"url": "jdbc:x", "partition": ("id", 1, 900, 16), "fetchsize": "50"}


def test_a_batch_that_is_run_again_replaces_its_rows(spark, tmp):
    """Two sinks behind one source: one query, and no row twice after a restart from an older state."""
    flow = (
        Pipeline.create("both")
        .add_processor("read", "GetFile", {"path": f"{tmp}/in", "schema": "id bigint", "option.maxFilesPerTrigger": "1"})
        .add_processor("route", "RouteOnAttribute", {"route.even": "id % 2 = 0"})
        .add_processor("a", "PutFile", {"path": f"{tmp}/a"})
        .add_processor("b", "PutFile", {"path": f"{tmp}/b"})
        .connect("read", "route").connect("route", "a", ["even"]).connect("route", "b", ["unmatched"])
        .build()
    )

    def drain():
        started = flow.run_stream(spark, checkpoint=f"{tmp}/progress")
        assert len(started) == 1
        for query in started:
            query.awaitTermination()

    spark.range(10).coalesce(1).write.parquet(f"{tmp}/in")
    drain()
    spark.range(10, 20).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    drain()
    # As if the process had ended before the last batch was marked as done.
    (done,) = [p for p in Path(f"{tmp}/progress/both/commits").iterdir() if p.name == "1"]
    done.unlink()
    for crc in Path(f"{tmp}/progress/both/commits").glob(".1.crc"):
        crc.unlink()
    drain()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/a").collect()) == list(range(0, 20, 2))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/b").collect()) == list(range(1, 20, 2))


def test_registered_type_and_sinks(spark, tmp):
    register("Twice", lambda df, props, env: {"success": df.unionAll(df)})
    flow = (
        Pipeline.create("x")
        .add_processor("twice", "org.example.Twice")
        .add_processor("file", "PutFile", {"path": f"{tmp}/f", "format": "json"})
        .add_processor("table", "PutDatabaseRecord", {"table": "plans_twice", "path": f"{tmp}/t"})
        .connect("twice", "file")
        .connect("twice", "table")
        .build()
    )
    out = flow.run(spark, {"twice": spark.range(3).toDF("id")})
    assert rows(out["file"]["success"]) == [(i,) for i in (0, 0, 1, 1, 2, 2)]
    assert out["table"]["success"].count() == 6
    more = (
        Pipeline.create("y")
        .add_processor("more", "PutSQL", {"table": "plans_twice"})
        .build()
    )
    more.run(spark, {"more": spark.range(3, 5).toDF("id")})
    read = Pipeline.create("z").add_processor(
        "read", "ExecuteSQL", {"query": "SELECT count(*) AS n FROM plans_twice"}
    ).build()
    assert read.run(spark)["read"]["success"].first().n == 8


# Sources

def test_files_need_a_known_format_and_schema(spark, tmp):
    with pytest.raises(ValueError, match="schema"):
        sources.read_files(spark, tmp, "csv")
    with pytest.raises(ValueError, match="format"):
        sources.read_files(spark, tmp, "other")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json", "xml"])
def test_files_round_trip(spark, tmp, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    options = {"rowTag": "row"} if fmt == "xml" else {}
    path = sources.write_files(df, f"{tmp}/{fmt}", fmt, **options)
    assert rows(sources.read_files(spark, path, fmt, df.schema, **options)) == rows(df)


def test_text_and_binary_files(spark, tmp):
    sources.write_files(spark.range(2).selectExpr("cast(id as string) AS value"), f"{tmp}/t", "text")
    assert rows(sources.read_files(spark, f"{tmp}/t", "text")) == [("0",), ("1",)]
    found = sources.read_files(spark, f"{tmp}/t", "binaryFile", pathGlobFilter="*.txt")
    assert found.agg(F.sum("length")).first()[0] == 4


def test_records_per_file(spark, tmp):
    df = spark.range(100).coalesce(1)
    sources.write_files(df, f"{tmp}/n", max_records_per_file=30)
    files = spark.read.parquet(f"{tmp}/n").select(F.input_file_name()).distinct().count()
    assert files == 4


def test_generated_rows_are_the_same_each_time(spark):
    a, b = (sources.generate(spark, 50, {"h": "hash(id)"}) for _ in range(2))
    assert rows(a) == rows(b) and a.count() == 50


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_size_check(spark):
    assert session.is_small(spark.range(5), 5) and not session.is_small(spark.range(6), 5)
    wide = spark.range(3).select(F.repeat(F.lit("x"), 40_000_000).alias("x"))
    assert not session.is_small(wide, 5)


# Streams

def _stream(spark, path, schema):
    return sources.read_stream(spark, "parquet", schema, path=path, maxFilesPerTrigger=1)


def _drain(df, tmp, name):
    query = sources.write_stream(df, "parquet", f"{tmp}/{name}-progress", path=f"{tmp}/{name}")
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{tmp}/{name}")


EVENTS = "id int, k string, kind string, n int, ts timestamp"


def _put(spark, path, *data):
    df = spark.createDataFrame(
        [(i, k, kind, n, ts) for i, k, kind, n, ts in data],
        "id int, k string, kind string, n int, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def _waits(spark, path):
    amount = F.when(F.col("kind") == "signal", F.col("n"))
    return wait_notify_stream(
        _stream(spark, path, EVENTS), "k", 3, 3600, amount, watermark="0 seconds", salts=2
    ).select("id", "k", "outcome")


def test_wait_notify_keeps_its_state_over_a_restart(spark, tmp):
    path = f"{tmp}/in"
    _put(
        spark, path,
        (1, "a", "wait", None, "2024-01-01 00:00:00"),
        (2, "b", "signal", 3, "2024-01-01 00:00:00"),   # signal before its waiting row
        (3, "a", "signal", 2, "2024-01-01 00:10:00"),
        (4, "c", "wait", None, "2024-01-01 00:00:00"),
    )
    assert rows(_drain(_waits(spark, path), tmp, "out")) == []
    _put(
        spark, path,
        (5, "a", "signal", 1, "2024-01-01 00:20:00"),
        (6, "b", "wait", None, "2024-01-01 00:20:00"),
        (7, "a", "wait", None, "2024-01-01 00:20:00"),
        (8, "a", "wait", None, "2024-01-01 04:00:00"),
    )
    # Time passes; what was held before the restart is decided with what came after it.
    _put(spark, path, (9, "d", "signal", 1, "2024-01-01 09:00:00"))
    first = [(1, "a", "released"), (4, "c", "expired"), (6, "b", "released"), (7, "a", "released"), (8, "a", "expired")]
    assert rows(_drain(_waits(spark, path), tmp, "out")) == first
    # Signals are forgotten, and a later row does not find them.
    _put(spark, path, (10, "a", "wait", None, "2024-01-01 09:00:01"))
    _put(spark, path, (11, "d", "signal", 1, "2024-01-01 19:00:00"))
    assert rows(_drain(_waits(spark, path), tmp, "out")) == sorted([*first, (10, "a", "expired")], key=repr)


@pytest.mark.parametrize("files", [1, 3, 8])
def test_wait_notify_does_not_depend_on_the_batches(spark, tmp, files):
    moves = [
        (1, "a", "wait", None, "2024-01-01 00:00:00"), (2, "a", "signal", 2, "2024-01-01 00:30:00"),
        (3, "b", "wait", None, "2024-01-01 00:40:00"), (4, "a", "signal", 1, "2024-01-01 00:59:00"),
        (5, "b", "signal", 1, "2024-01-01 01:00:00"), (6, "b", "signal", 1, "2024-01-01 03:00:00"),
        (7, "a", "wait", None, "2024-01-01 01:20:00"), (8, "z", "signal", 1, "2024-01-01 12:00:00"),
    ]
    moves.sort(key=lambda r: r[4])
    size = -(-len(moves) // files)
    for k in range(0, len(moves), size):
        _put(spark, f"{tmp}/in", *moves[k : k + size])
    out = _drain(_waits(spark, f"{tmp}/in"), tmp, "out")
    assert rows(out) == [(1, "a", "released"), (3, "b", "expired"), (7, "a", "released")]


@pytest.mark.parametrize("files, chunk", [(1, 4096), (3, 5), (30, 5)])
def test_wait_notify_by_running_sums(spark, tmp, files, chunk):
    """Busy keys with sealed chunks of state, out of order, against every pair of row and signal."""
    chance, minute = random.Random(6), datetime(2024, 1, 1)
    moves = []
    for i in range(360):
        at = minute + timedelta(minutes=i, seconds=chance.choice([0, 0, 30, -300]))
        kind = chance.choice(["wait", "signal"])
        moves.append((i, chance.choice("aab"), kind, chance.randint(0, 2) if kind == "signal" else None, str(at)))
    moves.append((999, "z", "signal", 1, "2024-01-02 00:00:00"))
    size = -(-len(moves) // files)
    for k in range(0, len(moves), size):
        _put(spark, f"{tmp}/in", *moves[k : k + size])
    amount = F.when(F.col("kind") == "signal", F.col("n"))
    df = wait_notify_stream(_stream(spark, f"{tmp}/in", EVENTS), "k", 12, 1200, amount, watermark="10 minutes", salts=2, chunk=chunk)
    found = rows(_drain(df.select("id", "outcome"), tmp, "out"))
    time = {m[0]: datetime.fromisoformat(m[4]) for m in moves}
    wanted = []
    for i, k, kind, _, _ in moves:
        if kind == "wait":
            near = [n for j, key, other, n, _ in moves if key == k and other == "signal" and abs(time[j] - time[i]) <= timedelta(seconds=1200)]
            wanted.append((i, "released" if sum(near) >= 12 else "expired"))
    assert found == sorted(wanted, key=repr)
    assert {"released", "expired"} == {o for _, o in wanted}


def test_stream_equals_batch(spark, tmp, folder):
    flow = (
        Pipeline.create("x")
        .add_processor("route", "RouteOnAttribute", {"route.high": "value > 20"})
        .add_processor("fields", "UpdateRecord", {"field.twice": "value * 2"},
                       {"schedulingPeriod": "5 min"})
        .add_processor("put", "PutFile", {"path": f"{tmp}/rows"})
        .connect("route", "fields", ["high"])
        .connect("fields", "put")
        .build()
    )
    events = spark.read.parquet(f"{folder}/events.parquet")
    stream = sources.read_stream(
        spark, "parquet", events.schema, path=folder, pathGlobFilter="events.parquet"
    )
    for query in flow.run_stream(spark, {"route": stream}, checkpoint=f"{tmp}/progress"):
        query.awaitTermination()
    batch = Pipeline.create("x").add_processor(
        "route", "RouteOnAttribute", {"route.high": "value > 20"}
    ).build().run(spark, {"route": events})["route"]["high"].withColumn("twice", F.expr("value * 2"))
    assert rows(spark.read.parquet(f"{tmp}/rows")) == rows(batch)
    with pytest.raises(ValueError, match="checkpoint"):
        flow.run_stream(spark, {"route": stream})


def test_wait_and_notify_types_in_a_stream(spark, tmp):
    """Signals and waiting rows meet at one node; the outcome goes to a table."""
    _put(
        spark, f"{tmp}/in",
        (1, "a", "wait", None, "2024-01-01 00:00:00"),
        (2, "a", "signal", 2, "2024-01-01 00:01:00"),
        (3, "b", "wait", None, "2024-01-01 00:00:00"),
        (4, "b", "signal", 1, "2024-01-01 05:00:00"),
    )
    flow = (
        Pipeline.create("x")
        .add_processor("kinds", "RouteOnAttribute", {"route.wait": "kind = 'wait'"})
        .add_processor("signal", "Notify", {"key": "k", "count": "n", "time": "ts"})
        .add_processor("hold", "Wait", {
            "key": "k", "target": "2", "time": "ts", "timeout": "3600", "watermark": "0 seconds"})
        .add_processor("out", "PutDatabaseRecord", {"table": "plans_released"})
        .connect("kinds", "signal", ["unmatched"])
        .connect("kinds", "hold", ["wait"])
        .connect("signal", "hold")
        .connect("hold", "out", ["released"])
        .build()
    )
    stream = _stream(spark, f"{tmp}/in", EVENTS)
    spark.sql(
        f"CREATE TABLE plans_released (id int, k string, kind string, n int, ts timestamp) "
        f"USING parquet LOCATION '{tmp}/table'"
    )
    for query in flow.run_stream(spark, {"kinds": stream}, checkpoint=f"{tmp}/progress"):
        query.awaitTermination()
    assert rows(spark.table("plans_released"), "id", "k") == [(1, "a")]


def test_window_counts_close_with_the_watermark(spark, tmp):
    path = f"{tmp}/queue"
    spark.createDataFrame(
        [("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-01 11:00:00"), ("b", 4, "2024-01-02 10:00:00")],
        "connection_id string, size_bytes bigint, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(path)
    stream = _stream(spark, path, "connection_id string, size_bytes bigint, ts timestamp_ntz")
    found = _drain(queue_status_stream(stream), tmp, "windows")
    assert rows(found, "connection_id", "queued_count", "queued_bytes") == [("a", 2, 3)]


def test_timer_period_is_the_trigger():
    def trigger(period):
        scheduling = {"schedulingPeriod": period} if period else {}
        return trigger_of(Pipeline.create("x").add_processor("a", "T", {}, scheduling).build().processor("a"))

    assert trigger("5 min") == {"processingTime": "300000 milliseconds"}
    assert trigger("1.5 sec") == {"processingTime": "1500 milliseconds"}
    assert trigger(None) == trigger(" ") == {"availableNow": True}
    with pytest.raises(ValueError, match="period"):
        trigger("0 0/5 * * * ?")


def test_rows_of_one_folder_come_together_and_a_hot_one_is_split(spark, tmp):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4))
    df = spark.range(0, 200_000, 1, 8).select(key.alias("k"), "id", F.xxhash64("id").alias("x"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256KB")
    try:
        sources.write_files(df, f"{tmp}/by", partition_by=["k"])
    finally:
        spark.conf.set(size, before)
    written = spark.read.parquet(f"{tmp}/by")
    named = written.select("k", F.input_file_name().alias("file")).distinct()
    files = {r.k: r["count"] for r in named.groupBy("k").count().collect()}
    assert written.count() == 200_000
    assert files["hot"] > 1
    assert sum(files.values()) < 8 * len(files)


def test_late_rows_have_a_relationship(spark, tmp):
    _put(spark, f"{tmp}/in", (1, "a", "x", 1, "2024-01-01 10:00:00"), (2, "a", "x", 1, None))
    _put(spark, f"{tmp}/in", (3, "a", "x", 1, "2024-01-03 10:00:00"), (4, "a", "x", 1, "2024-01-01 23:00:00"))
    _put(spark, f"{tmp}/in", (5, "a", "x", 1, "2024-01-01 23:59:59"), (6, "a", "x", 1, "2024-01-03 00:00:00"), (7, "a", "x", 1, "2024-01-02 01:00:00"))
    found = label_late(_stream(spark, f"{tmp}/in", EVENTS), "1 day", "1 hour").select("id", "relationship")
    assert rows(_drain(found, tmp, "out")) == [(1, "on_time"), (2, "late"), (3, "on_time"), (4, "on_time"), (5, "late"), (6, "on_time"), (7, "late")]


def test_rate_source(spark, tmp):
    rate = sources.read_stream(spark, "rate-micro-batch", rowsPerBatch=7, numPartitions=2)
    query = sources.write_stream(rate, "parquet", f"{tmp}/p", {"processingTime": "0 seconds"}, path=f"{tmp}/r")
    while not (query.lastProgress and query.lastProgress.batchId >= 2):
        assert query.isActive
        time.sleep(0.2)
    query.stop()
    found = spark.read.schema("timestamp timestamp, value bigint").parquet(f"{tmp}/r")
    values = sorted(r.value for r in found.select("value").collect())
    assert values and values == list(range(len(values)))
