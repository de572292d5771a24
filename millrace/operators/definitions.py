"""A corpus of pipeline definitions as tables: parse, default, look up, export.

A definition is one JSON text in one row. Parsing gives one table for each kind
of child, all keyed by ``pipeline_id`` and ordered by ``pos``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import short_type_name
from millrace.functions.maps import STRING_MAP, empty_map
from millrace.functions.text import BLANKS
from millrace.operators.lookup import lookup_join
from millrace.operators.ordered import large_keys, of_keys, row_numbers

# The reject reasons, in the order they are tried.
REASON_BLANK = "definition is required."
REASON_NOT_OBJECT = "definition must be a valid JSON object."
REASON_NO_NAME = 'Pipeline definition must include a "name" field.'
REASON_PROCESSOR = 'Each processor must have a "type" field.'
REASON_CONNECTION = 'Each connection must have "source" and "destination" fields.'
REASON_SERVICE = 'Each controller service must have a "type" field.'
REASON_CONTEXT = 'Each parameter context must have a "name" field.'

# The relationship of an edge that names none.
DEFAULT_RELATIONSHIPS = ["success"]

# The fields that hold a definition's children.
CHILDREN = ["processors", "connections", "controllerServices", "parameterContexts", "ports"]

# The parameters of a context as a JSON object.
PARAMETER_MAP = "map<string,struct<value:string,sensitive:boolean,description:string>>"

# The scheduling keys a manifest keeps.
SCHEDULING_KEYS = [
    "schedulingStrategy",
    "schedulingPeriod",
    "concurrentlySchedulableTaskCount",
    "penaltyDuration",
    "yieldDuration",
    "executionNode",
]


@dataclass(frozen=True)
class Definitions:
    """The tables of a parsed corpus. ``rejects`` has one reason for each bad definition."""

    pipelines: DataFrame
    processors: DataFrame
    connections: DataFrame
    services: DataFrame
    contexts: DataFrame
    parameters: DataFrame
    ports: DataFrame
    rejects: DataFrame


def _get(value: Column | str, path: str, as_type: str = "string") -> Column:
    return F.try_variant_get(value, path, as_type)


def _trimmed(text: Column) -> Column:
    """The text without blanks at its ends; most long ones have none, which is cheap to see."""
    ends = F.substring(text, 1, 1).isin(*BLANKS) | F.substring(text, -1, 1).isin(*BLANKS)
    return F.when(ends, F.btrim(text, F.lit(BLANKS))).otherwise(text)


def _items(doc: Column | str, field: str) -> Column:
    """The children under a field: a list, or the values of an object; else none."""
    path = f"$.{field}"
    return F.coalesce(
        _get(doc, path, "array<variant>"),
        F.map_values(_get(doc, path, "map<string,variant>")),
        F.array().cast("array<variant>"),
    )


def _any_without(items: Column, *paths: str) -> Column:
    def lacks(item: Column) -> Column:
        missing = F.lit(False)
        for path in paths:
            missing = missing | _get(item, path).isNull()
        return missing

    return F.exists(items, lacks)


def _is_collection(value: Column | str) -> Column:
    return (
        _get(value, "$", "map<string,variant>").isNotNull()
        | _get(value, "$", "array<variant>").isNotNull()
    )


def _truthy(value: Column) -> Column:
    """Whether a JSON scalar counts as true: ``''``, ``'0'``, 0, false and absent do not."""
    kind = F.schema_of_variant(value)
    text = _get(value, "$")
    return F.coalesce(
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", ~text.isin("", "0"))
        .when(kind.rlike("^(OBJECT|ARRAY)"), ~text.isin("{}", "[]"))
        .otherwise(text.try_cast("double") != 0),
        F.lit(False),
    )


def parse_definitions(
    df: DataFrame, id_col: str, json_col: str, part_col: str | None = None
) -> Definitions:
    """Split definition texts into child tables and rejects, without a Python UDF.

    With ``part_col`` the rows of one id are the parts that ``definition_documents`` writes:
    positions go on from part to part, the first part names the definition, and a fault
    in any part rejects it as a whole, once, for the first such fault. The slices of a large
    context, in several parts, are one context again, its parameters in order.

    Each table reads only what it needs of the text. A caller that uses several
    of them may persist ``df`` or write the tables.
    """
    # As the output of a generator a text is trimmed and parsed once, where a plain column
    # would be repeated in every test that a filter makes of it.
    parsed = df.select(
        F.col(id_col).cast("string").alias("pipeline_id"),
        (F.col(part_col) if part_col else F.lit(0)).cast("bigint").alias("part"),
        F.explode(F.array(_trimmed(F.col(json_col)))).alias("text"),
    ).withColumn("raw", F.nullif("text", F.lit("")))
    parsed = parsed.select(
        "pipeline_id", "raw", "part", F.explode(F.array(F.try_parse_json("raw"))).alias("doc")
    )
    reason = (
        F.when(F.col("raw").isNull(), REASON_BLANK)
        .when(F.col("doc").isNull() | ~F.substring("raw", 1, 1).isin("{", "["), REASON_NOT_OBJECT)
        .when(F.coalesce(_get("doc", "$.name"), F.lit("")) == "", REASON_NO_NAME)
        .when(_any_without(_items("doc", "processors"), "$.type"), REASON_PROCESSOR)
        .when(
            _any_without(_items("doc", "connections"), "$.source", "$.destination"),
            REASON_CONNECTION,
        )
        .when(_any_without(_items("doc", "controllerServices"), "$.type"), REASON_SERVICE)
        .when(_any_without(_items("doc", "parameterContexts"), "$.name"), REASON_CONTEXT)
    )
    judged = parsed.withColumn("reason", reason)
    before = {field: F.lit(0) for field in CHILDREN}
    if part_col:
        # As a struct the key is shuffled by wherever the rows lie, so tables that are read
        # together share what is parsed up to here.
        parts = Window.partitionBy(F.struct("pipeline_id")).orderBy("part")
        earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
        whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = {
            field: F.coalesce(F.sum(F.size(_items("doc", field))).over(earlier), F.lit(0)).cast("int")
            for field in CHILDREN
        }
        judged = judged.withColumn("reason", F.first("reason", ignorenulls=True).over(whole))
    judged = judged.withColumns({f"before_{field}": n for field, n in before.items()})
    good = judged.where(F.col("reason").isNull()).drop("reason")

    def one_row(rows: DataFrame, column: str) -> DataFrame:
        """``column`` of each definition, from its first part."""
        if part_col:
            rows = rows.groupBy("pipeline_id").agg(F.min_by(column, "part").alias(column))
        return rows.select("pipeline_id", column)

    def children(field: str) -> DataFrame:
        exploded = good.select(
            "pipeline_id", "raw", f"before_{field}", F.posexplode(_items("doc", field)).alias("at", "item")
        )
        return exploded.withColumn("pos", F.col(f"before_{field}") + F.col("at"))

    def text_map(path: str) -> Column:
        return F.coalesce(_get("item", path, STRING_MAP), empty_map())

    named = F.coalesce(_get("item", "$.name"), short_type_name(_get("item", "$.type")))
    contexts = children("parameterContexts").withColumns({"slice": _get("item", "$.slice", "int"), "of": _get("item", "$.of", "int")})
    # A parsed object has its names in alphabetical order; the text has them as they were written.
    written = F.expr("json_object_keys(get_json_object(raw, concat('$.parameterContexts[', at, '].parameters')))")
    entries = contexts.select(
        "pipeline_id",
        F.col("pos").alias("context_pos"),
        "slice",
        "of",
        _get("item", "$.name").alias("context"),
        written.alias("written"),
        F.posexplode(_get("item", "$.parameters", "map<string,variant>")).alias("at", "name", "entry"),
    ).withColumn("pos", F.coalesce(F.nullif(F.array_position("written", F.col("name")), F.lit(0)) - 1, F.col("at")).cast("int"))
    if part_col:
        # Slices go to the place of the first, their parameters behind those of earlier slices.
        slices = contexts.where("slice IS NOT NULL AND of IS NOT NULL")
        n = F.coalesce(F.size(_get("item", "$.parameters", "map<string,variant>")), F.lit(0))
        earlier = Window.partitionBy("pipeline_id", "of").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        begins = slices.groupBy("pipeline_id", "of", "slice").agg(F.max(n).alias("n")).select(
            "pipeline_id", "of", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
        )
        home = slices.where("slice = 0").groupBy("pipeline_id", "of").agg(F.min("pos").alias("home"))
        entries = lookup_join(entries, home, ["pipeline_id", "of"]).withColumn("context_pos", F.coalesce("home", "context_pos"))
        entries = lookup_join(entries, begins, ["pipeline_id", "of", "slice"]).withColumn("pos", (F.col("pos") + F.coalesce("begin", F.lit(0))).cast("int"))
        contexts = contexts.where("slice IS NULL OR of IS NULL OR slice = 0")
    is_entry = F.coalesce(_is_collection("entry"), F.lit(False))
    return Definitions(
        pipelines=one_row(good.withColumn("name", _get("doc", "$.name")), "name"),
        processors=children("processors").select(
            "pipeline_id",
            "pos",
            named.alias("name"),
            _get("item", "$.type").alias("type"),
            text_map("$.properties").alias("properties"),
            text_map("$.scheduling").alias("scheduling"),
            F.coalesce(
                _get("item", "$.autoTerminatedRelationships", "array<string>"),
                F.array().cast("array<string>"),
            ).alias("auto_terminated"),
        ),
        connections=children("connections").select(
            "pipeline_id",
            "pos",
            _get("item", "$.source").alias("source"),
            _get("item", "$.destination").alias("destination"),
            F.coalesce(
                _get("item", "$.relationships", "array<string>"),
                F.array(*[F.lit(r) for r in DEFAULT_RELATIONSHIPS]),
            ).alias("relationships"),
            _get("item", "$.backPressure.objectThreshold", "bigint").alias("object_threshold"),
            _get("item", "$.backPressure.dataSizeThreshold").alias("size_threshold"),
        ),
        services=children("controllerServices").select(
            "pipeline_id",
            "pos",
            named.alias("name"),
            _get("item", "$.type").alias("type"),
            text_map("$.properties").alias("properties"),
        ),
        contexts=contexts.select(
            "pipeline_id",
            "pos",
            _get("item", "$.name").alias("name"),
            F.coalesce(_get("item", "$.description"), F.lit("")).alias("description"),
        ),
        parameters=entries.select(
            "pipeline_id",
            "context_pos",
            "context",
            "name",
            F.coalesce(
                F.when(is_entry, _get("entry", "$.value")).otherwise(_get("entry", "$")),
                F.lit(""),
            ).alias("value"),
            F.when(is_entry, _truthy(_get("entry", "$.sensitive", "variant")))
            .otherwise(F.lit(False))
            .alias("sensitive"),
            F.when(is_entry, _get("entry", "$.description")).alias("description"),
            "pos",
        ),
        ports=children("ports").select(
            "pipeline_id",
            "pos",
            _get("item", "$.name").alias("name"),
            F.coalesce(_get("item", "$.type"), F.lit("INPUT")).alias("port_type"),
        ),
        rejects=one_row(judged.where(F.col("reason").isNotNull()), "reason"),
    )


def normalise_components(df: DataFrame) -> DataFrame:
    """Fill the default name from the type and the default relationships, where the columns exist.

    An explicit empty name or list is kept.
    """
    if "type" in df.columns and "name" in df.columns:
        df = df.withColumn("name", F.coalesce("name", short_type_name("type")))
    if "relationships" in df.columns:
        default = F.array(*[F.lit(r) for r in DEFAULT_RELATIONSHIPS])
        df = df.withColumn("relationships", F.coalesce("relationships", default))
    return df


def first_by_name(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in definition order, as a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("first")).select(*keys, "first.*")


def nest_documents(
    parents: DataFrame,
    key: str,
    header: Mapping[str, Column],
    children: Mapping[str, tuple],
    part_rows: int = 10_000,
) -> DataFrame:
    """One JSON document for each parent, with its children as ordered lists.

    ``children`` maps a field to (table with ``key``, position, item), if need be with
    the least part that an item may be in. The rows of all tables meet in one shuffle,
    already as text; only parents with more rows than one task should sort are cut before. A parent with more than ``part_rows`` children of a kind is written
    as several documents numbered by ``part``, each with the header and the next ``part_rows`` of every list, counted in
    the order of position (null first) and text, whatever the positions are. So no list
    is longer than ``part_rows``, and ``parse_definitions`` can join the parts again.
    """

    kinds = {kind: number for number, kind in enumerate(children, 1)}

    def rows(df: DataFrame, kind: int, pos: Column, body: Column, least: Column = F.lit(0)) -> DataFrame:
        return df.select(
            key,
            F.lit(kind).alias("kind"),
            pos.cast("bigint").alias("pos"),
            body.alias("body"),
            least.cast("bigint").alias("least"),
        )

    # A parent without children has a first part, too. Of equal parents the largest header counts.
    head = F.to_json(F.struct(*[column.alias(name) for name, column in header.items()]))
    pieces = rows(parents, 0, F.lit(0), head)
    for kind, (df, pos, item, *least) in children.items():
        pieces = pieces.unionByName(rows(df, kinds[kind], pos, F.to_json(item), *least))

    def grouped(ranked: DataFrame, *more: Column) -> DataFrame:
        """The parts with a bounded list of each kind."""
        of_kind = [
            F.sort_array(F.collect_list(F.when(F.col("kind") == number, F.struct("rank", "body")))).alias(f"list_{number}")
            for number in kinds.values()
        ]
        part = F.when(F.col("kind") == 0, 0).otherwise(F.greatest(F.floor((F.col("rank") - 1) / part_rows), "least"))
        return ranked.groupBy(key, part.alias("part")).agg(*of_kind, *more)

    # All rows of a parent are in one task, headers first, unless there are too many of them.
    found = large_keys(pieces, [key])
    usual = (pieces if found is None else of_keys(pieces, found, [key], "left_anti")).repartition(key)
    in_kind = Window.partitionBy(key, "kind").orderBy("pos", "body")
    so_far = Window.partitionBy(key).orderBy("kind", "pos", "body").rowsBetween(Window.unboundedPreceding, 0)
    usual = usual.withColumn("rank", F.row_number().over(in_kind).cast("bigint")).withColumn(
        "head", F.max(F.when((F.col("kind") == 0) & F.col(key).isNotNull(), F.col("body"))).over(so_far)
    )
    parts = grouped(usual, F.max("head").alias("head"))
    if found is not None:
        # The children of a parent of any size are numbered by slices.
        large = of_keys(pieces, found, [key], "left_semi")
        heads = large.where("kind = 0").groupBy(key).agg(F.max("body").alias("head"))
        ranked = row_numbers(large, [key, "kind"], ["pos", "body"], "rank")
        parts = parts.unionByName(lookup_join(grouped(ranked), heads, key))

    lists = [
        F.concat(F.lit(f'"{kind}":['), F.array_join(F.col(f"list_{number}.body"), ","), F.lit("]"))
        for kind, number in kinds.items()
    ]
    opening = F.when(F.col("head") != "{}", F.expr("concat(left(head, length(head) - 1), ',')"))
    document = F.concat(
        F.coalesce(opening, F.lit("{")), F.concat_ws(",", *lists), F.lit("}")
    )
    return parts.select(key, "part", document.alias("document"))


def _non_empty(collection: str) -> Column:
    return F.when(F.size(collection) > 0, F.col(collection))


def _component(*fields: Column) -> Column:
    revision = F.struct(F.lit(0).alias("version"))
    return F.struct(revision.alias("revision"), F.struct(*fields).alias("component"))


def _contexts_with_parameters(definitions: Definitions, part_rows: int) -> DataFrame:
    """Contexts with their parameters in definition order (by name where none is known); a very large context in slices."""
    keys = ["pipeline_id", "context_pos"]
    entry = F.struct(
        F.struct(
            F.col("name"),
            F.col("value"),
            F.col("sensitive"),
            F.nullif("description", F.lit("")).alias("description"),
        ).alias("parameter")
    )
    table = definitions.parameters
    if "pos" not in table.columns:
        table = table.withColumn("pos", F.lit(None).cast("int"))
    listed = (
        row_numbers(table, keys, ["pos", "name"], "rank")
        .groupBy(*keys, F.floor((F.col("rank") - 1) / part_rows).alias("slice"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("items"))
        .select(*keys, "slice", F.col("items.entry").alias("parameters"))
    )
    return definitions.contexts.withColumnRenamed("pos", "context_pos").join(listed, keys, "left")


def definition_documents(definitions: Definitions, part_rows: int = 10_000) -> DataFrame:
    """The JSON form that ``parse_definitions`` reads, as (pipeline_id, part, document).

    A definition with more than ``part_rows`` children of a kind comes in parts, and a context
    with more parameters in slices, one to a part, which parsing joins again. A context's
    parameters have different names.
    """
    contexts = _contexts_with_parameters(definitions, part_rows)
    sliced = F.max("slice").over(Window.partitionBy("pipeline_id", "context_pos")) > 0
    contexts = contexts.withColumn("sliced", F.coalesce(sliced, F.lit(False)))
    entry = lambda p: F.struct(
        p["parameter"]["name"], F.struct(p["parameter"]["value"], p["parameter"]["sensitive"], p["parameter"]["description"])
    )
    parameters = F.map_from_entries(F.transform("parameters", entry))
    context = F.struct(
        F.col("name"),
        F.nullif("description", F.lit("")).alias("description"),
        F.when(F.col("sliced"), F.col("context_pos")).alias("of"),
        F.when(F.col("sliced"), F.col("slice")).alias("slice"),
        F.coalesce(parameters, F.create_map().cast(PARAMETER_MAP)).alias("parameters"),
    )
    processor = F.struct(
        "name", "type", _non_empty("properties").alias("properties"), _non_empty("scheduling").alias("scheduling"),
        _non_empty("auto_terminated").alias("autoTerminatedRelationships"),
    )
    pressure = F.when(
        F.col("object_threshold").isNotNull() | F.col("size_threshold").isNotNull(),
        F.struct(F.col("object_threshold").alias("objectThreshold"), F.col("size_threshold").alias("dataSizeThreshold")),
    )
    connection = F.struct("source", "destination", "relationships", pressure.alias("backPressure"))
    pos = F.col("pos")
    return nest_documents(
        definitions.pipelines,
        "pipeline_id",
        {"name": F.col("name")},
        {
            "processors": (definitions.processors, pos, processor),
            "connections": (definitions.connections, pos, connection),
            "controllerServices": (definitions.services, pos, F.struct("name", "type", _non_empty("properties").alias("properties"))),
            "parameterContexts": (contexts, F.col("context_pos"), context, F.coalesce("slice", F.lit(0))),
            "ports": (definitions.ports, pos, F.struct("name", F.col("port_type").alias("type"))),
        },
        part_rows,
    )


def manifest(definitions: Definitions, part_rows: int = 10_000) -> DataFrame:
    """The deployment manifest of each definition, as (pipeline_id, part, document).

    Empty maps, empty lists and blank descriptions are left out.
    """
    config = [
        _non_empty("properties").alias("properties"),
        *[F.try_element_at("scheduling", F.lit(k)).alias(k) for k in SCHEDULING_KEYS],
        _non_empty("auto_terminated").alias("autoTerminatedRelationships"),
    ]
    any_config = (F.size("properties") > 0) | (F.size("auto_terminated") > 0) | F.arrays_overlap(
        F.map_keys("scheduling"), F.array(*[F.lit(k) for k in SCHEDULING_KEYS])
    )
    processor = _component(
        F.col("type"), F.col("name"), F.when(any_config, F.struct(*config)).alias("config")
    )

    def end(id_col: str) -> Column:
        known = F.col(id_col) if id_col in definitions.connections.columns else F.lit("")
        return F.struct(
            F.coalesce(known, F.lit("")).alias("id"), F.lit("PROCESSOR").alias("type")
        )

    connection = _component(
        end("source_id").alias("source"),
        end("destination_id").alias("destination"),
        F.col("relationships").alias("selectedRelationships"),
        F.col("object_threshold").alias("backPressureObjectThreshold"),
        F.col("size_threshold").alias("backPressureDataSizeThreshold"),
    )
    service = _component(F.col("type"), F.col("name"), _non_empty("properties").alias("properties"))
    contexts = _contexts_with_parameters(definitions, part_rows)
    no_parameters = F.array().cast(contexts.schema["parameters"].dataType)
    context = _component(
        F.col("name"),
        F.coalesce("parameters", no_parameters).alias("parameters"),
        F.nullif("description", F.lit("")).alias("description"),
    )
    # A slice of a large context goes to a later part, so no document has all of them.
    slice_of = F.coalesce("slice", F.lit(0))
    port_type = F.when(F.col("port_type") == "INPUT", "INPUT_PORT").otherwise("OUTPUT_PORT")
    port = _component(F.col("name"), port_type.alias("type"))
    pos = F.col("pos")
    return nest_documents(
        definitions.pipelines,
        "pipeline_id",
        {"processGroup": _component(F.col("name"))},
        {
            "parameterContexts": (contexts, F.col("context_pos"), context, slice_of),
            "controllerServices": (definitions.services, pos, service),
            "processors": (definitions.processors, pos, processor),
            "connections": (definitions.connections, pos, connection),
            "ports": (definitions.ports, pos, port),
        },
        part_rows,
    )
