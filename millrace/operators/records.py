"""Record transforms: attributes, fields, text, JSON shape, format, batches, SQL."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import merge_maps
from millrace.operators.ordered import row_numbers
from millrace.operators.routing import split_outcome


def _column(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def update_attributes(
    df: DataFrame, attributes: Mapping[str, Column | str], col: str = "attributes"
) -> DataFrame:
    """Set attributes to expressions; other attributes stay."""
    pairs = [
        item
        for name, value in attributes.items()
        for item in (F.lit(name), _column(value).cast("string"))
    ]
    return df.withColumn(col, merge_maps(F.col(col), F.create_map(*pairs)))


def update_record(df: DataFrame, fields: Mapping[str, Column | str | None]) -> DataFrame:
    """Set fields to expressions; ``None`` removes a field.

    ``a.b`` is a nested field; ``a[].b`` is the field of every element of a list,
    where an expression may use ``item`` for the element.
    """
    for path, value in fields.items():
        if "[]." in path:
            outer, inner = path.split("[].", 1)
            df = df.withColumn(outer, _changed_elements(df, outer, inner, value))
        elif "." in path:
            outer, inner = path.split(".", 1)
            struct = F.col(outer)
            df = df.withColumn(
                outer,
                struct.dropFields(inner) if value is None else struct.withField(inner, _column(value)),
            )
        else:
            df = df.drop(path) if value is None else df.withColumn(path, _column(value))
    return df


def _changed_elements(df: DataFrame, outer: str, inner: str, value: Column | str | None) -> Column:
    if value is None:
        return F.transform(outer, lambda item: item.dropFields(inner))
    if isinstance(value, Column):
        return F.transform(outer, lambda item: item.withField(inner, value))
    names = [f.name for f in df.schema[outer].dataType.elementType.fields]
    if inner not in names:
        names.append(inner)
    fields = ", ".join(f"'{n}', {value if n == inner else f'item.`{n}`'}" for n in names)
    return F.expr(f"transform({outer}, item -> named_struct({fields}))")


def replace_text(df: DataFrame, col: str, pattern: str, replacement: str) -> DataFrame:
    """Replace every match of a regular expression in the whole text."""
    return df.withColumn(col, F.regexp_replace(col, pattern, replacement))


def restructure_json(df: DataFrame, col: str, spec: Sequence[Mapping]) -> dict[str, DataFrame]:
    """Reshape JSON text by a list of steps, as ``success``; ``failure`` has what is no object, as it was.

    ``{"op": "shift", "fields": {from: to}}`` keeps only the named fields and
    moves them; ``{"op": "default", "fields": {to: value}}`` fills what is
    missing; ``{"op": "remove", "fields": [to]}`` takes out. Paths are dotted; a
    source path may end in ``:type`` to cast, such as ``a.b:int``, and is text
    otherwise. Without a shift the other fields stay and paths are top-level.
    The steps are compiled once to column expressions.
    """
    if not spec:
        raise ValueError("there are no steps")
    # Columns of their own, so that each text is parsed once for all its fields.
    df = df.withColumn("_doc", F.try_parse_json(col))
    tree: dict[str, Column] | None = None
    if spec[0]["op"] != "shift":
        df = df.withColumn("_entries", F.try_variant_get("_doc", "$", "map<string,variant>"))
    for step in spec:
        op, fields = step["op"], step["fields"]
        if op == "shift":
            tree = {}
            for source, target in fields.items():
                path, _, kind = source.partition(":")
                tree[target] = F.try_variant_get("_doc", f"$.{path}", kind or "string")
        elif op == "default" and tree is None:
            df = df.withColumn("_entries", _with_defaults(F.col("_entries"), fields))
        elif op == "default":
            for target, value in fields.items():
                known = [tree[target]] if target in tree else []
                tree[target] = F.coalesce(*known, F.lit(value))
        elif op == "remove" and tree is None:
            df = df.withColumn("_entries", _without(F.col("_entries"), fields))
        elif op == "remove":
            gone = tuple(f"{target}." for target in fields)
            tree = {k: v for k, v in tree.items() if not f"{k}.".startswith(gone)}
        else:
            raise ValueError(f"unknown step: {op}")
    shaped = F.col("_entries") if tree is None else _nested(tree)
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    return {
        "success": df.where(is_object).withColumn(col, F.to_json(shaped)).drop("_doc", "_entries"),
        "failure": df.where(~is_object).drop("_doc", "_entries"),
    }


def _without(entries: Column, fields: Sequence[str]) -> Column:
    return F.map_filter(entries, lambda name, _: ~name.isin(list(fields)))


def _with_defaults(entries: Column, fields: Mapping) -> Column:
    pairs = [x for k, v in fields.items() for x in (F.lit(k), F.parse_json(F.lit(json.dumps(v))))]
    missing = F.map_filter(
        F.create_map(*pairs), lambda name, _: ~F.map_contains_key(entries, name)
    )
    return F.map_concat(entries, missing)


def _nested(tree: Mapping[str, Column]) -> Column:
    """A struct from dotted names."""
    groups: dict[str, dict[str, Column] | Column] = {}
    for name, value in tree.items():
        head, _, rest = name.partition(".")
        if rest:
            groups.setdefault(head, {})[rest] = value
        else:
            groups[head] = value
    return F.struct(
        *[
            (_nested(part) if isinstance(part, dict) else part).alias(name)
            for name, part in groups.items()
        ]
    )


_BAD = "_bad_record"


def convert_records(
    df: DataFrame,
    col: str,
    from_fmt: str,
    to_fmt: str,
    schema: str | T.StructType,
    read_options: Mapping[str, str] | None = None,
    write_options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Convert one record for each row between ``csv``, ``json`` and ``xml`` text.

    Rows that do not fit the schema go to ``failure``, unchanged and with a reason.
    """
    ddl = schema.simpleString()[7:-1] if isinstance(schema, T.StructType) else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, **(read_options or {})}
    readers = {"csv": F.from_csv, "json": F.from_json, "xml": F.from_xml}
    writers = {"csv": F.to_csv, "json": F.to_json, "xml": F.to_xml}
    record = readers[from_fmt](F.col(col), f"{ddl}, {_BAD} string", options)
    parsed = df.withColumn("_record", record)
    ok = F.col("_record").isNotNull() & F.col(f"_record.{_BAD}").isNull()
    routed = split_outcome(
        parsed, ok, F.concat(F.lit(f"not a {from_fmt} record of the schema: "), F.coalesce(col, F.lit("null")))
    )
    written = writers[to_fmt](F.col("_record").dropFields(_BAD), dict(write_options or {}))
    return {
        "success": routed["success"].withColumn(col, written).drop("_record"),
        "failure": routed["failure"].drop("_record"),
    }


def split_records(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    n: int,
    slice_by: Column | None = None,
) -> DataFrame:
    """Number the batches of ``n`` records of each key, in order, as ``batch`` from 0.

    Keys may be of any size and order columns of any type, see ``ordered``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    numbered = row_numbers(df, keys, orders, "_number", slice_by)
    return numbered.withColumn("batch", F.floor((F.col("_number") - 1) / n)).drop("_number")


def query_record(
    frames: DataFrame | Mapping[str, DataFrame], sql: str, args: Mapping | None = None
) -> DataFrame:
    """SQL over record sets. Write ``{name}`` for a frame, ``:name`` for an argument.

    A single frame is called ``{records}``.
    """
    named = {"records": frames} if isinstance(frames, DataFrame) else dict(frames)
    spark: SparkSession = next(iter(named.values())).sparkSession
    return spark.sql(sql, args=dict(args) if args else None, **named)
