"""Parameters: bind, inherit, substitute, mask, override, set and remove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import merge_maps
from millrace.functions.maps import STRING_MAP
from millrace.operators.lookup import lookup_join
from millrace.session import cut_lineage, fits_broadcast

# How a text refers to a parameter.
REFERENCE = r"#\{([^}]+)\}"


def override_properties(
    df: DataFrame, overrides: DataFrame, on: str, col: str = "properties"
) -> DataFrame:
    """Merge one override map for each ``on`` value into ``col``; the override wins."""
    newer = overrides.select(on, F.col(col).alias("_newer"))
    return (
        df.join(newer, on, "left")
        .withColumn(col, merge_maps(F.col(col), F.col("_newer")))
        .drop("_newer")
        .select(*df.columns)
    )


def mask_sensitive(params: DataFrame) -> DataFrame:
    """Parameters with the value of sensitive ones set to null."""
    return params.withColumn("value", F.when(~F.coalesce("sensitive", F.lit(False)), F.col("value")))


def bind_context(pipelines: DataFrame, contexts: DataFrame) -> DataFrame:
    """Each pipeline with the first context of its definition, null where it has none."""
    first = contexts.groupBy("pipeline_id").agg(F.min_by("name", "pos").alias("context"))
    return pipelines.join(first, "pipeline_id", "left")


def _rebuild(col: str, value_of) -> Column:
    """The text with each reference replaced in one pass; values are not scanned again."""
    literals = F.split(col, REFERENCE, -1)
    names = F.regexp_extract_all(col, F.lit(REFERENCE), 1)
    piece = lambda text, name: F.concat(
        F.coalesce(text, F.lit("")),
        F.when(name.isNull(), "").otherwise(
            F.coalesce(value_of(name), F.concat(F.lit("#{"), name, F.lit("}")))
        ),
    )
    return F.array_join(F.zip_with(literals, names, piece), "")


def substitute(df: DataFrame, col: str, params: DataFrame, context: str) -> DataFrame:
    """Replace ``#{name}`` in ``col`` by the parameters of the context the row names.

    Unknown names stay in the text and are listed in ``unresolved``. Of a parameter that
    is given more than once in a context the smallest value holds; one without a name or
    a context is never referred to. References become rows, meet their values on
    (context, name) and return to their text; texts without one take no part in that. A
    text is found again by its content and context, so equal texts are looked up once.
    """
    names = F.regexp_extract_all(col, F.lit(REFERENCE), 1)
    texts = (
        df.where(F.size(names) > 0)
        .select(F.col(context).alias("_context"), F.col(col).alias("_text"))
        .distinct()
    )
    wanted = texts.select(
        "_context", "_text", F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(REFERENCE), 1))).alias("_name")
    )
    values = params.groupBy(F.col("context").alias("_context"), F.col("name").alias("_name")).agg(
        F.min(F.struct("value")).alias("_value")
    )
    # One text names finitely many parameters, so this list is bounded by the text.
    found = wanted.join(values, ["_context", "_name"]).groupBy("_context", "_text").agg(
        F.map_from_entries(F.collect_list(F.struct("_name", "_value.value"))).alias("_values")
    )
    joined = lookup_join(df, found, [(context, "_context"), (col, "_text")]).withColumn(
        "_values", F.coalesce("_values", F.create_map().cast(STRING_MAP))
    )
    return joined.withColumn(
        "unresolved", F.filter(names, lambda name: ~F.map_contains_key("_values", name))
    ).withColumn(
        col, _rebuild(col, lambda name: F.try_element_at("_values", name))
    ).drop("_values")


def apply_params(params: DataFrame, sets: DataFrame, removals: DataFrame) -> DataFrame:
    """Set, change and remove parameters of contexts.

    ``sets`` has a ``seq``; the last set of a name wins over earlier ones and over
    the current value. A removal beats a set of the same name.
    """
    key = ["context", "name"]
    rest = [c for c in params.columns if c not in key]
    current = params.withColumn("seq", F.lit(None).cast("bigint"))
    latest = (
        current.unionByName(sets.select(*params.columns, F.col("seq").cast("bigint")))
        .groupBy(*key)
        .agg(
            F.max_by(
                F.struct(*rest),
                F.struct(F.col("seq").isNotNull(), F.coalesce("seq", F.lit(0))),
            ).alias("latest")
        )
        .select(*key, "latest.*")
    )
    removed = removals.select(*key).distinct()
    return latest.join(removed, key, "left_anti").select(*params.columns)


# Why a text of parameters is rejected.
REASON_NOT_ENTRIES = "parameters must be a JSON object."


def parse_parameter_entries(df: DataFrame, context: str, json: str) -> tuple[DataFrame, DataFrame]:
    """Parameter sets given as JSON text, as rows for ``apply_params``, and the rejects.

    An entry is a value, or an object with ``value``, ``sensitive`` and ``description``;
    what it lacks is an empty value, not sensitive, no description. The rows are
    (context, name, value, sensitive, description) with the other columns of ``df``; a text
    that is no JSON object is rejected as it is, with a reason. A blank text sets nothing.
    """
    rest = [c for c in df.columns if c not in (context, json)]
    parsed = df.withColumn("_entries", F.try_variant_get(F.try_parse_json(json), "$", "map<string,variant>"))
    blank = F.coalesce(F.trim(json), F.lit("")) == ""
    entries = parsed.where(F.col("_entries").isNotNull()).select(
        F.col(context).alias("context"), *rest, F.explode("_entries").alias("name", "_entry")
    )
    get = lambda path, kind="string": F.try_variant_get("_entry", path, kind)
    is_object = F.coalesce(F.schema_of_variant("_entry").startswith("OBJECT"), F.lit(False))
    rows = entries.select(
        "context",
        "name",
        F.coalesce(F.when(is_object, get("$.value")).otherwise(get("$")), F.lit("")).alias("value"),
        F.coalesce(F.when(is_object, get("$.sensitive", "boolean")), F.lit(False)).alias("sensitive"),
        F.when(is_object, get("$.description")).alias("description"),
        *rest,
    )
    rejects = parsed.where(F.col("_entries").isNull() & ~blank).drop("_entries").withColumn(
        "reason", F.lit(REASON_NOT_ENTRIES)
    )
    return rows, rejects


def inherited_params(params: DataFrame, inherits: DataFrame) -> DataFrame:
    """The parameters each context sees: its own and those of the contexts it inherits from.

    ``inherits`` has (child, parent, rank). The nearest level wins, then the
    lowest rank on the way there. Chains of any length are followed; a cycle ends
    where a context would meet itself. A parameter that is given twice in a context has
    the smaller value.

    Parameters move down one level in each round, and only those that a context does not
    see yet, so what is written are the parameters that contexts see, not pairs of contexts.
    """
    entry = F.struct("ranks", "value", "sensitive", "origin")
    start = params.groupBy("context", "name").agg(F.min(F.struct("value", "sensitive")).alias("own")).select(
        "context",
        "name",
        F.struct(F.array().cast("array<int>").alias("ranks"), "own.value", "own.sensitive", F.col("context").alias("origin")).alias("entry"),
        F.lit(0).alias("depth"),
    )
    level, rows, size = cut_lineage(start)
    seen, depth = level, 0
    up = inherits.select("child", F.col("parent").alias("context"), F.col("rank").cast("int").alias("rank"))
    while rows:
        depth += 1
        moving = F.broadcast(level) if fits_broadcast(rows, size) else level
        ranks = F.concat(F.array("rank"), F.col("entry.ranks")).alias("ranks")
        moved = up.join(moving, "context").select(F.col("child").alias("context"), "name", ranks, "entry.value", "entry.sensitive", "entry.origin")
        new = moved.groupBy("context", "name").agg(F.min(entry).alias("entry")).withColumn("depth", F.lit(depth))
        level, rows, size = cut_lineage(new.join(seen, ["context", "name"], "left_anti"))
        if rows:
            seen = seen.unionByName(level)
    return seen.select("context", "name", "entry.value", "entry.sensitive", "entry.origin", "depth")
