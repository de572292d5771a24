"""Checks over definition tables. Every rule gives issue rows; none stops at the first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.definitions import Definitions
from millrace.operators.lookup import lookup_join

# The message of each rule; %s is filled with the subject.
MESSAGES = {
    "empty": "Pipeline must contain at least one processor.",
    "duplicate_processor": "Duplicate processor name: '%s'.",
    "missing_type": "Processor '%s' is missing a type.",
    "dangling_source": "Connection source '%s' does not match any processor name.",
    "dangling_destination": "Connection destination '%s' does not match any processor name.",
    "no_relationships": "Connection '%s' → '%s' has no relationships.",
    "duplicate_service": "Duplicate controller service name: '%s'.",
    "duplicate_context": "Duplicate parameter context name: '%s'.",
}

# Repeats written by one generated row; a key with more repeats gets several rows.
_CHUNK = 10_000


def empty_parents(parent: DataFrame, child: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Parents without any child."""
    keys = [on] if isinstance(on, str) else list(on)
    return parent.join(child.select(*keys).distinct(), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each repeat of a key after the first, numbered by ``repeat``.

    Rows are counted where they are read. The repeats of a very frequent key
    are written by many tasks, in chunks, and never held as one list.
    """
    counted = df.groupBy(*keys).count().where("count > 1")
    chunk = F.explode(F.expr(f"sequence(0, (count - 2) div {_CHUNK})")).alias("chunk")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = counted.select(*keys, "count", chunk).repartition(tasks, *keys, "chunk")
    last = f"least(count - 1, (chunk + 1) * {_CHUNK})"
    repeat = F.explode(F.expr(f"sequence(chunk * {_CHUNK} + 1, {last})")).alias("repeat")
    return chunks.select(*keys, repeat)


def blank_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of the columns is an empty text."""
    return df.where(reduce(Column.__or__, [F.col(c) == "" for c in cols]))


def dangling_refs(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows that refer to no parent row; ``on`` pairs child columns with parent columns."""
    return lookup_join(child, parent.select(*[p for _, p in on]).distinct(), on, "left_anti")


def empty_list(df: DataFrame, col: str) -> DataFrame:
    """Rows whose list is empty."""
    return df.where(F.size(col) == 0)


def _issues(df: DataFrame, rule: str, *subject: str) -> DataFrame:
    message = F.format_string(MESSAGES[rule], *subject) if subject else F.lit(MESSAGES[rule])
    shown = F.concat_ws(" → ", *subject) if subject else F.lit(None).cast("string")
    return df.select(
        "pipeline_id",
        F.lit(rule).alias("rule"),
        shown.alias("subject"),
        message.alias("message"),
    )


def dangling_edges(connections: DataFrame, processors: DataFrame) -> DataFrame:
    """Edge ends that name no processor, as (pipeline_id, rule, name).

    Both ends of an edge are looked up in one pass.
    """
    ends = connections.select(
        "pipeline_id",
        F.explode(
            F.array(
                F.struct(F.lit("dangling_source").alias("rule"), F.col("source").alias("name")),
                F.struct(
                    F.lit("dangling_destination").alias("rule"),
                    F.col("destination").alias("name"),
                ),
            )
        ).alias("end"),
    ).select("pipeline_id", "end.*")
    return dangling_refs(ends, processors, [("pipeline_id", "pipeline_id"), ("name", "name")])


def validate(definitions: Definitions) -> DataFrame:
    """All issues of a corpus as (pipeline_id, rule, subject, message)."""
    d = definitions
    name_key = ["pipeline_id", "name"]
    dangling = dangling_edges(d.connections, d.processors)
    return reduce(
        DataFrame.unionByName,
        [
            _issues(empty_parents(d.pipelines, d.processors, "pipeline_id"), "empty"),
            _issues(duplicate_keys(d.processors, name_key), "duplicate_processor", "name"),
            _issues(blank_required(d.processors, ["type"]), "missing_type", "name"),
            dangling.select(
                "pipeline_id",
                "rule",
                F.col("name").alias("subject"),
                F.when(
                    F.col("rule") == "dangling_source",
                    F.format_string(MESSAGES["dangling_source"], "name"),
                )
                .otherwise(F.format_string(MESSAGES["dangling_destination"], "name"))
                .alias("message"),
            ),
            _issues(
                empty_list(d.connections, "relationships"),
                "no_relationships",
                "source",
                "destination",
            ),
            _issues(duplicate_keys(d.services, name_key), "duplicate_service", "name"),
            _issues(duplicate_keys(d.contexts, name_key), "duplicate_context", "name"),
        ],
    )


def summarise(definitions: Definitions, issues: DataFrame | None = None) -> DataFrame:
    """Child counts of each definition without issues, from one aggregate over all tables."""
    d = definitions
    tables = {
        "processors": d.processors,
        "connections": d.connections,
        "services": d.services,
        "contexts": d.contexts,
        "ports": d.ports,
    }
    tagged = d.pipelines.select("pipeline_id", F.lit("pipeline").alias("kind"), "name")
    none = F.lit(None).cast("string").alias("name")
    for kind, df in tables.items():
        tagged = tagged.unionByName(df.select("pipeline_id", F.lit(kind).alias("kind"), none))
    found = validate(d) if issues is None else issues
    tagged = tagged.unionByName(found.select("pipeline_id", F.lit("issue").alias("kind"), none))
    counts = [F.count_if(F.col("kind") == kind).alias(kind) for kind in tables]
    return (
        tagged.groupBy("pipeline_id")
        .agg(
            F.max("name").alias("name"),
            *counts,
            F.count_if(F.col("kind") == "issue").alias("_issues"),
            F.count_if(F.col("kind") == "pipeline").alias("_known"),
        )
        .where("_issues = 0 and _known > 0")
        .select("pipeline_id", "name", *tables)
    )
