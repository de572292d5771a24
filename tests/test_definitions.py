import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import definitions as d
from millrace.operators import ordered
from millrace.operators import validate as v
from millrace.plans import DefinitionError, Pipeline

VALID = {
    "name": "CSV intake",
    "processors": [
        {"name": "fetch", "type": "org.example.GetFile", "properties": {"path": "/in"}},
        {"name": "parse", "type": "org.example.ConvertRecord"},
        {"name": "store", "type": "org.example.PutDatabaseRecord"},
    ],
    "connections": [
        {"source": "fetch", "destination": "parse", "relationships": ["success"]},
        {"source": "parse", "destination": "store", "relationships": ["success"]},
    ],
}
DANGLING = {
    "name": "squeeze",
    "processors": [
        {
            "name": "tail-logs",
            "type": "org.example.GetFile",
            "properties": {"depth": "7"},
            "scheduling": {"schedulingPeriod": "90 sec"},
            "autoTerminatedRelationships": ["failure"],
        }
    ],
    "connections": [{"source": "tail-logs", "destination": "squash"}],
    "controllerServices": [{"type": "org.example.Pool", "properties": {"url": "#{store_at}"}}],
    "parameterContexts": [
        {
            "name": "limits",
            "description": "Bounds of the run",
            "parameters": {
                "store_at": "shelf-3",
                "pin": {"value": "0417", "sensitive": True},
                "odd": {"sensitive": "0"},
                "listed": [1],
                "absent": None,
                "n": 5,
            },
        }
    ],
}


def corpus(spark, *texts):
    rows = [(str(i), t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return d.parse_definitions(spark.createDataFrame(rows, "id string, text string"), "id", "text")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


BROKEN = [
    (None, d.REASON_BLANK),
    (" \t\n", d.REASON_BLANK),
    ("{broken", d.REASON_NOT_OBJECT),
    ("7", d.REASON_NOT_OBJECT),
    ("[]", d.REASON_NO_NAME),
    ('{"name":""}', d.REASON_NO_NAME),
    ('{"name":"x","processors":[{"name":"a"}]}', d.REASON_PROCESSOR),
    ('{"name":"x","processors":[{"type":null}]}', d.REASON_PROCESSOR),
    ('{"name":"x","processors":[3],"connections":[{}]}', d.REASON_PROCESSOR),
    ('{"name":"x","connections":[{"source":"a"}]}', d.REASON_CONNECTION),
    ('{"name":"x","controllerServices":[{}]}', d.REASON_SERVICE),
    ('{"name":"x","parameterContexts":[{"parameters":{}}]}', d.REASON_CONTEXT),
]


def test_one_reject_reason_each_in_order(spark):
    parsed = corpus(spark, *[text for text, _ in BROKEN])
    found = {r.pipeline_id: r.reason for r in parsed.rejects.collect()}
    assert found == {str(i): reason for i, (_, reason) in enumerate(BROKEN)}
    assert parsed.pipelines.isEmpty() and parsed.processors.isEmpty()


@pytest.mark.parametrize("text, reason", BROKEN)
def test_builder_side_gives_the_same_reasons(text, reason):
    with pytest.raises(DefinitionError, match=".*"):
        try:
            Pipeline.from_json(text)
        except DefinitionError as error:
            assert str(error) == reason
            raise


def test_children(spark):
    parsed = corpus(spark, VALID, DANGLING)
    assert rows(parsed.processors, "pipeline_id", "pos", "name") == [
        ("0", 0, "fetch"), ("0", 1, "parse"), ("0", 2, "store"), ("1", 0, "tail-logs"),
    ]
    fetch = parsed.processors.where("name = 'tail-logs'").first()
    assert fetch.properties == {"depth": "7"}
    assert fetch.scheduling == {"schedulingPeriod": "90 sec"}
    assert fetch.auto_terminated == ["failure"]
    assert rows(parsed.services, "name", "properties") == [("Pool", {"url": "#{store_at}"})]
    assert rows(parsed.contexts, "name", "description") == [("limits", "Bounds of the run")]
    assert rows(parsed.parameters, "name", "value", "sensitive") == [
        ("absent", "", False),
        ("listed", "", False),
        ("n", "5", False),
        ("odd", "", False),
        ("pin", "0417", True),
        ("store_at", "shelf-3", False),
    ]


def test_defaults(spark):
    parsed = corpus(
        spark,
        {
            "name": "x",
            "processors": [
                {"type": "a.b.", "properties": [1]}, {"type": "a.b", "name": ""}, {"type": ""},
            ],
            "connections": [
                {"source": "a", "destination": "b"},
                {"source": "a", "destination": "b", "relationships": []},
                {"source": "a", "destination": "b", "relationships": "no list"},
            ],
        },
    )
    assert rows(parsed.processors, "pos", "name", "properties") == [
        (0, "a.b.", {}), (1, "", {}), (2, "", {}),
    ]
    assert rows(parsed.connections, "pos", "relationships") == [
        (0, ["success"]), (1, []), (2, ["success"]),
    ]


def test_last_of_repeated_json_keys_counts(spark):
    parsed = corpus(spark, '{"name":"a","name":"b"}')
    assert parsed.pipelines.first().name == "b"


def messages(spark, definition):
    return sorted(r.message for r in v.validate(corpus(spark, definition)).collect())


CASES = [
    (VALID, []),
    (DANGLING, [v.MESSAGES["dangling_destination"] % "squash"]),
    ({"name": "x"}, [v.MESSAGES["empty"]]),
    (
        {"name": "x", "processors": [{"type": "t", "name": "a"}] * 3},
        [v.MESSAGES["duplicate_processor"] % "a"] * 2,
    ),
    (
        {"name": "x", "processors": [{"type": "", "name": "a"}],
         "connections": [{"source": "b", "destination": "a", "relationships": []}]},
        [
            "Connection 'b' → 'a' has no relationships.",
            v.MESSAGES["dangling_source"] % "b",
            "Processor 'a' is missing a type.",
        ],
    ),
    (
        {"name": "x", "processors": [{"type": "t"}],
         "controllerServices": [{"type": "s"}, {"type": "s"}],
         "parameterContexts": [{"name": "c"}, {"name": "c"}]},
        [v.MESSAGES["duplicate_service"] % "s", v.MESSAGES["duplicate_context"] % "c"],
    ),
]


@pytest.mark.parametrize("definition, expected", CASES)
def test_issues(spark, definition, expected):
    assert messages(spark, definition) == expected
    assert sorted(Pipeline.from_json(json.dumps(definition)).issues()) == expected


def test_many_repeats_come_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(v, "_CHUNK", 7)
    df = spark.range(100).select((F.col("id") % 3).alias("k"))
    found = [r.repeat for r in v.duplicate_keys(df, ["k"]).where("k = 0").collect()]
    assert sorted(found) == list(range(1, 34))


def test_summary_leaves_out_definitions_with_issues(spark):
    found = v.summarise(corpus(spark, VALID, DANGLING)).collect()
    assert [tuple(r) for r in found] == [("0", "CSV intake", 3, 2, 0, 0, 0)]


def test_manifest(spark):
    documents = d.manifest(corpus(spark, VALID, DANGLING))
    found = {r.pipeline_id: json.loads(r.document) for r in documents.collect()}
    zero = {"version": 0}
    assert found["0"]["processGroup"] == {"revision": zero, "component": {"name": "CSV intake"}}
    assert [p["component"]["name"] for p in found["0"]["processors"]] == ["fetch", "parse", "store"]
    assert "config" not in found["0"]["processors"][1]["component"]
    assert found["1"]["processors"] == [
        {
            "revision": zero,
            "component": {
                "type": "org.example.GetFile",
                "name": "tail-logs",
                "config": {
                    "properties": {"depth": "7"},
                    "schedulingPeriod": "90 sec",
                    "autoTerminatedRelationships": ["failure"],
                },
            },
        }
    ]
    assert found["1"]["connections"][0]["component"]["selectedRelationships"] == ["success"]
    (context,) = found["1"]["parameterContexts"]
    assert context["component"]["description"] == "Bounds of the run"
    assert {"parameter": {"name": "pin", "value": "0417", "sensitive": True}} in context[
        "component"
    ]["parameters"]
    assert found["0"]["parameterContexts"] == [] and found["0"]["ports"] == []


def test_large_definition_is_written_in_parts(spark):
    many = {
        "name": "big",
        "processors": [{"type": "t", "name": f"p{i}"} for i in range(25)],
        "connections": [{"source": "p0", "destination": "p1"}] * 3,
        "parameterContexts": [
            {"name": "c", "parameters": {f"k{i}": str(i) for i in range(45)}}
        ],
    }
    parts = d.manifest(corpus(spark, many), part_rows=10).orderBy("part").collect()
    documents = [json.loads(p.document) for p in parts]
    assert [p.part for p in parts] == list(range(len(parts)))
    assert all(doc["processGroup"]["component"]["name"] == "big" for doc in documents)
    assert all(len(doc["processors"]) <= 10 for doc in documents)
    names = [p["component"]["name"] for doc in documents for p in doc["processors"]]
    assert names == [f"p{i}" for i in range(25)]
    parameters = [
        p["parameter"]["name"]
        for doc in documents
        for c in doc["parameterContexts"]
        for p in c["component"]["parameters"]
    ]
    assert parameters == [f"k{i}" for i in range(45)]


def test_slices_of_a_context_are_one_context_again(spark):
    """Two contexts of one name, both cut into slices, one without parameters, and one small."""
    many = {
        "name": "big",
        "processors": [{"type": "t", "name": "p"}],
        "parameterContexts": [
            {"name": "c", "description": "first", "parameters": {f"k{i:02d}": {"value": str(i), "sensitive": i % 2 == 0} for i in range(45)}},
            {"name": "c", "parameters": {f"z{i:02d}": str(i) for i in range(23)}},
            {"name": "none"},
            {"name": "small", "parameters": {"b": "1", "a": "2"}},
        ],
        "ports": [{"name": "in", "type": "INPUT"}],
    }
    parsed = corpus(spark, many)
    documents = d.definition_documents(parsed, part_rows=10)
    assert documents.count() > 4
    assert all(len(c["parameters"]) <= 10 for r in documents.collect() for c in json.loads(r.document)["parameterContexts"])
    again = d.parse_definitions(documents, "pipeline_id", "document", "part")
    # Only the repeat that was there is a repeat.
    assert [r.rule for r in v.validate(again).collect()] == ["duplicate_context"]
    contexts = {r.pos: r for r in again.contexts.collect()}
    assert sorted(c.name for c in contexts.values()) == ["c", "c", "none", "small"]
    found = {}
    for r in again.parameters.orderBy("pos").collect():
        found.setdefault((contexts[r.context_pos].name, contexts[r.context_pos].description), []).append((r.name, r.value, r.sensitive))
    assert found == {
        ("c", "first"): [(f"k{i:02d}", str(i), i % 2 == 0) for i in range(45)],
        ("c", ""): [(f"z{i:02d}", str(i), False) for i in range(23)],
        ("small", ""): [("b", "1", False), ("a", "2", False)],
    }
    assert rows(again.ports, "name", "port_type") == [("in", "INPUT")]


def test_parameters_keep_the_order_of_the_definition(spark):
    definition = {"name": "x", "parameterContexts": [{"name": "c", "parameters": {"zeta": "1", "alpha": "2", "mid": {"value": "3"}}}]}
    parsed = corpus(spark, definition)
    assert rows(parsed.parameters, "pos", "name") == [(0, "zeta"), (1, "alpha"), (2, "mid")]
    (row,) = d.manifest(parsed).collect()
    (context,) = json.loads(row.document)["parameterContexts"]
    assert [p["parameter"]["name"] for p in context["component"]["parameters"]] == ["zeta", "alpha", "mid"]


@pytest.mark.parametrize("positions", ["dense", "repeated", "sparse", "null"])
def test_parts_are_joined_again(spark, positions):
    """Parts are cut by rank, whatever the positions, and lose nothing."""
    n = 10_001 if positions == "dense" else 50
    pos = {"dense": F.col("id"), "repeated": F.col("id") % 3, "sparse": F.col("id") * 1000, "null": F.lit(None)}[positions]
    children = spark.range(n).select(F.lit("a").alias("pipeline_id"), pos.cast("int").alias("pos"), F.format_string("p%05d", "id").alias("name"))
    parents = spark.createDataFrame([("a", "big"), ("b", "none")], "pipeline_id string, name string")
    item = F.struct("name", F.lit("org.example.T").alias("type"))
    size = 10_000 if positions == "dense" else 7
    documents = d.nest_documents(parents, "pipeline_id", {"name": F.col("name")}, {"processors": (children, F.col("pos"), item)}, size)
    assert documents.where("pipeline_id = 'a'").count() == -(-n // size)
    again = d.parse_definitions(documents, "pipeline_id", "document", "part")
    assert again.rejects.count() == 0 and rows(again.pipelines, "pipeline_id", "name") == [("a", "big"), ("b", "none")]
    found = again.processors.orderBy("pos").collect()
    assert [r.pos for r in found] == list(range(n)) and len({r.name for r in found}) == n
    if positions in ("dense", "sparse"):
        assert [r.name for r in found] == [f"p{i:05d}" for i in range(n)]


def _nested(spark, part_rows=7):
    """Parents of 0 to 90 children of two kinds, one named twice, one not there, one null."""
    data = [(k, i % 5 if i % 3 else None, f"c{i:02d}") for k in ("a", "b", "c", None, "lost") for i in range({"a": 90, "b": 8, "c": 3}.get(k, 20))]
    children = spark.createDataFrame(data, "pipeline_id string, pos int, name string")
    parents = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "BB"), ("c", "C"), ("d", "D"), (None, "N")], "pipeline_id string, name string")
    item = F.struct("name")
    few = children.where("name < 'c12'")
    found = d.nest_documents(parents, "pipeline_id", {"name": F.col("name")}, {"x": (children, F.col("pos"), item), "y": (few, F.col("pos"), item)}, part_rows)
    return sorted(((r.pipeline_id or "", r.part, r.document) for r in found.collect()))


def test_usual_parents_are_not_dealt(spark, monkeypatch):
    """Only parents too large for a task are cut into slices first; both ways give the same."""
    with monkeypatch.context() as patch:
        patch.setattr(ordered, "_measured", None)
        usual = _nested(spark)
    assert [(k, part) for k, part, _ in usual if k == "a"] == [("a", i) for i in range(13)]
    assert {json.loads(text).get("name") for k, _, text in usual if k in ("", "lost")} == {None}
    assert {json.loads(text)["name"] for k, _, text in usual if k == "b"} == {"BB"}
    want = sorted((-1 if i % 3 == 0 else i % 5, f"c{i:02d}") for i in range(90))
    assert [x["name"] for k, _, text in usual if k == "a" for x in json.loads(text)["x"]] == [name for _, name in want]
    monkeypatch.setattr(ordered, "HASHES", 2)
    for rows_of_a_task in (0, 25, 60):
        monkeypatch.setattr(ordered, "TASK_ROWS", rows_of_a_task)
        assert _nested(spark) == usual


def test_only_large_keys_are_dealt(spark, monkeypatch):
    data = [(k, i) for k in (1, 2, None) for i in range(9 * (k or 3))]
    df = spark.createDataFrame(data, "k int, i int")
    monkeypatch.setattr(ordered, "TASK_ROWS", 20)
    assert sorted(r.k or 0 for r in ordered.large_keys(df, ["k"]).collect()) == [0]
    assert all(r.n == r.i + 1 for r in ordered.row_numbers(df, ["k"], ["i"], "n").collect())
    monkeypatch.setattr(ordered, "_measured", None)
    assert ordered.large_keys(df.where("k = 1"), ["k"]) is None
    assert all(r.n == r.i + 1 for r in ordered.row_numbers(df.where("k = 1"), ["k"], ["i"], "n").collect())


def test_a_fault_in_one_part_rejects_the_definition_once(spark):
    parts = [("a", 0, '{"name":"x"}'), ("a", 1, '{"name":"x","processors":[{}]}'), ("a", 2, "broken"), ("b", 0, '{"name":"y"}')]
    parsed = d.parse_definitions(spark.createDataFrame(parts, "id string, part int, text string"), "id", "text", "part")
    assert rows(parsed.rejects, "pipeline_id", "reason") == [("a", d.REASON_PROCESSOR)]
    assert rows(parsed.pipelines, "pipeline_id") == [("b",)]


def test_json_round_trip(spark):
    """Nesting the parsed tables and parsing again changes nothing."""
    first = corpus(spark, VALID, DANGLING)
    documents = d.nest_documents(
        first.pipelines,
        "pipeline_id",
        {"name": F.col("name")},
        {
            "processors": (
                first.processors,
                F.col("pos"),
                F.struct(
                    "name", "type", "properties", "scheduling",
                    F.col("auto_terminated").alias("autoTerminatedRelationships"),
                ),
            ),
            "connections": (
                first.connections, F.col("pos"), F.struct("source", "destination", "relationships"),
            ),
            "controllerServices": (
                first.services, F.col("pos"), F.struct("name", "type", "properties"),
            ),
        },
    )
    again = d.parse_definitions(documents, "pipeline_id", "document")
    for table in ("pipelines", "processors", "connections", "services"):
        a, b = getattr(first, table), getattr(again, table)
        assert rows(a, *a.columns) == rows(b, *a.columns)


def test_builder_json_round_trip(spark):
    flow = (
        Pipeline.create("x")
        .add_processor("a", "org.example.GetFile", {"p": "1"}, {"schedulingPeriod": "5 min"}, ["failure"])
        .connect("a", "a", ["success"], {"objectThreshold": 10, "dataSizeThreshold": "1 GB"})
        .with_controller_service("s", "Pool", {"url": "u"})
        .with_parameter_context("c", {"k": "v"}, "about")
        .with_input_port("in")
        .with_output_port("out")
        .build()
    )
    assert Pipeline.from_json(flow.to_json()) == flow or Pipeline.from_json(
        flow.to_json()
    ).to_json() == flow.to_json()
    parsed = corpus(spark, flow.to_json())
    edge = parsed.connections.first()
    assert (edge.object_threshold, edge.size_threshold) == (10, "1 GB")
    assert rows(parsed.ports, "name", "port_type") == [("in", "INPUT"), ("out", "OUTPUT")]


def test_table_schemas(spark):
    parsed = corpus(spark, VALID)
    expected = {
        "pipelines": schemas.PIPELINES, "processors": schemas.PROCESSORS,
        "connections": schemas.CONNECTIONS, "services": schemas.SERVICES,
        "contexts": schemas.CONTEXTS, "parameters": schemas.PARAMETERS,
        "ports": schemas.PORTS, "rejects": schemas.REJECTS,
    }
    for table, ddl in expected.items():
        wanted = spark.createDataFrame([], ddl).dtypes
        assert getattr(parsed, table).dtypes == wanted, table
    assert v.validate(parsed).dtypes == spark.createDataFrame([], schemas.ISSUES).dtypes
