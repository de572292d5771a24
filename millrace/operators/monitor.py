"""Queries over operational tables: provenance, history, bulletins, queues, status, search."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import size_bytes
from millrace.operators.graph import subtree
from millrace.operators.lookup import lookup_join
from millrace.session import scratch_path

# Rows that a top-k may hold in one task; pages further down are looked for by counting.
PAGE_ROWS = 10_000
# Splitters of one round of counting.
SPLITTERS = 64
# Letters of an index entry.
GRAM = 3
# Entries of an index that a task sorts.
INDEX_ROWS = 2_000_000


def list_children(df: DataFrame, group_id, col: str = "group_id") -> DataFrame:
    """The components directly in a group."""
    return df.where(F.col(col) == group_id)


def get_by_id(df: DataFrame, id_value, col: str = "id") -> DataFrame:
    """The component with an id."""
    return df.where(F.col(col) == id_value)


def get_event(events: DataFrame, event_id) -> DataFrame:
    """One provenance event."""
    return get_by_id(events, event_id, "event_id")


def _given(value) -> bool:
    return value is not None and (not isinstance(value, str) or value.strip() != "")


def provenance_search(
    events: DataFrame,
    processor_id=None,
    component_type=None,
    flowfile_uuid=None,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    max_results: int = 100,
    offset: int = 0,
) -> DataFrame:
    """Events that match all given filters, newest first. Blank filters do not count.

    ``start`` and ``end`` are inclusive. ``offset`` skips that many of them, see ``page``.
    """
    if not isinstance(max_results, int) or max_results < 1:
        raise ValueError("max_results must be a positive integer")
    wanted = {
        "processor_id": processor_id,
        "component_type": component_type,
        "flowfile_uuid": flowfile_uuid,
    }
    for col, value in wanted.items():
        if _given(value):
            events = events.where(F.col(col) == value)
    ts_type = dict(events.dtypes)["ts"]
    if _given(start):
        events = events.where(F.col("ts") >= F.lit(start).cast(ts_type))
    if _given(end):
        events = events.where(F.col("ts") <= F.lit(end).cast(ts_type))
    return page(events, ["ts", "event_id"], max_results, offset)


def page(df: DataFrame, order: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """The rows at ``offset`` to ``offset + limit`` by ``order`` descending (nulls last), at any depth.

    A page near the top is a top-k. For any other, rows are counted between splitters from
    a sample; only the range that holds the page is looked into again, until it is of the
    size of a page. So no task holds, and nothing shuffles, the rows in front of it.
    """
    key = F.struct(*order)
    types = {c: df.schema[c].dataType for c in order}
    rest, newest = df, [F.desc(c) for c in order]
    while offset + limit > PAGE_ROWS:
        sample = rest.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(SPLITTERS).distinct().orderBy(F.desc("k"))
        splitters = [r["k"] for r in sample.collect()]
        bounds = [F.struct(*[F.lit(k[c]).cast(types[c]).alias(c) for c in order]) for k in splitters]
        above = sum(((key < b).cast("int") for b in bounds), F.lit(0))
        counts = {r["bucket"]: r["n"] for r in rest.groupBy(above.alias("bucket")).agg(F.count("*").alias("n")).collect()}
        skipped, first = 0, 0
        while first < len(bounds) and skipped + counts.get(first, 0) <= offset:
            skipped += counts.get(first, 0)
            first += 1
        last, seen = first, skipped + counts.get(first, 0)
        while last < len(bounds) and seen < offset + limit:
            last += 1
            seen += counts.get(last, 0)
        # A bucket is what lies below a splitter, down to and with the next one.
        if first:
            rest = _beside(rest.where(key < bounds[first - 1]), order[0], splitters[first - 1][order[0]], types, True)
        if last < len(bounds):
            rest = _beside(rest.where(key >= bounds[last]), order[0], splitters[last][order[0]], types, False)
        offset -= skipped
        if seen - skipped == sum(counts.values()) or seen - skipped <= PAGE_ROWS:
            break
    return rest.orderBy(*newest).offset(offset).limit(limit)


def _beside(df: DataFrame, col: str, value, types: dict, below: bool) -> DataFrame:
    """The bound of the first order column alone, which is pushed to the scan; nulls lie below all."""
    if value is None:
        return df
    bound = F.lit(value).cast(types[col])
    return df.where((F.col(col) <= bound) | F.col(col).isNull() if below else F.col(col) >= bound)


def history(df: DataFrame, limit: int = 50, offset: int = 0, source_id=None) -> DataFrame:
    """One page of the action history, newest first, at any depth."""
    if _given(source_id):
        df = df.where(F.col("source_id") == source_id)
    return page(df, ["ts", "action_id"], limit, offset)


def bulletins(
    df: DataFrame, levels: Sequence[str] = ("WARNING", "ERROR"), limit: int | None = None
) -> DataFrame:
    """Bulletins of the given levels, newest first."""
    board = df.where(F.col("level").isin(list(levels))).orderBy(
        F.desc("ts"), F.desc("bulletin_id")
    )
    return board if limit is None else board.limit(limit)


def bulletin_counts(df: DataFrame, levels: Sequence[str] = ("WARNING", "ERROR")) -> DataFrame:
    """Bulletins of the given levels, counted by source and level."""
    return (
        df.where(F.col("level").isin(list(levels)))
        .groupBy("source_id", "level")
        .agg(F.count("*").alias("bulletins"), F.max("ts").alias("latest"))
    )


def flow_status(
    components: DataFrame,
    queue: DataFrame,
    states: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Components in total and by state, with queued count and bytes, from one aggregate.

    ``by`` are columns of both tables, such as a group id; without them there is one row.
    """
    flag = lambda state: (F.col("state") == state).cast("bigint")
    names = {state: f"state_{state.lower()}" for state in states}
    parts = components.select(
        *by,
        F.lit(1).cast("bigint").alias("components"),
        *[F.coalesce(flag(s), F.lit(0)).alias(n) for s, n in names.items()],
        F.lit(0).cast("bigint").alias("queued_count"),
        F.lit(0).cast("bigint").alias("queued_bytes"),
    ).unionByName(
        queue.select(
            *by,
            F.lit(0).cast("bigint").alias("components"),
            *[F.lit(0).cast("bigint").alias(n) for n in names.values()],
            F.lit(1).cast("bigint").alias("queued_count"),
            F.col("size_bytes").alias("queued_bytes"),
        )
    )
    measures = [c for c in parts.columns if c not in by]
    return parts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures])


def queue_status(queue: DataFrame, connection_id=None) -> DataFrame:
    """Count, bytes and oldest entry of each queue."""
    if _given(connection_id):
        queue = queue.where(F.col("connection_id") == connection_id)
    return queue.groupBy("connection_id").agg(
        F.count("*").alias("queued_count"),
        F.sum("size_bytes").alias("queued_bytes"),
        F.min("ts").alias("oldest"),
    )


def back_pressure(queue: DataFrame, connections: DataFrame) -> DataFrame:
    """Every connection with its queue and whether a threshold is reached.

    A threshold that is null sets no limit. ``connections`` has (connection_id,
    object_threshold, size_threshold), the size as text such as ``1 GB``.
    """
    status = queue_status(queue).drop("oldest")
    full = lambda used, limit: F.coalesce(used >= limit, F.lit(False))
    return (
        connections.select(
            "connection_id",
            "object_threshold",
            size_bytes("size_threshold").alias("size_threshold_bytes"),
        )
        .join(status, "connection_id", "left")
        .withColumns(
            {
                "queued_count": F.coalesce("queued_count", F.lit(0)),
                "queued_bytes": F.coalesce("queued_bytes", F.lit(0)),
            }
        )
        .withColumns(
            {
                "over_count": full(F.col("queued_count"), F.col("object_threshold")),
                "over_bytes": full(F.col("queued_bytes"), F.col("size_threshold_bytes")),
            }
        )
        .withColumn("under_pressure", F.col("over_count") | F.col("over_bytes"))
    )


def _holds(df: DataFrame, col: str, wanted: Column) -> Column:
    kind = dict(df.dtypes)[col]
    if kind.startswith("map<"):
        return F.exists(F.map_values(col), lambda value: F.contains(F.lower(value), wanted))
    return F.contains(F.lower(F.col(col).cast("string")), wanted)


def search_components(
    df: DataFrame,
    query: str,
    cols: Sequence[str] = ("name", "type", "properties"),
    group_id=None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Components with the text in any of the columns; case does not matter.

    With ``group_id`` only that group counts, with ``groups`` also all groups nested in it.
    """
    if not _given(query):
        raise ValueError("query is required")
    wanted = F.lower(F.lit(query.strip()))
    match = F.lit(False)
    for col in cols:
        if col in df.columns:
            match = match | F.coalesce(_holds(df, col, wanted), F.lit(False))
    found = df.where(match)
    if _given(group_id):
        if groups is None:
            return found.where(F.col("group_id") == group_id)
        nested = subtree(groups, group_id).select("group_id")
        found = lookup_join(found, nested, "group_id", "left_semi")
    return found


def index_components(df: DataFrame, cols: Sequence[str] = ("name", "type", "properties"), id_col: str = "id", path: str | None = None) -> DataFrame:
    """The index of a table for ``search_components_indexed``, written to ``path``: (gram, id), each once.

    A text has an entry for each GRAM letters in a row, or is one if it is shorter. Entries
    lie in order, so a search reads the parts of the table that its entries can be in.
    """
    texts = []
    for col in cols:
        if col in df.columns:
            is_map = dict(df.dtypes)[col].startswith("map<")
            texts.append(F.map_values(col) if is_map else F.array(F.col(col).cast("string")))
    entries = lambda text: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(GRAM))
    )
    parts = F.flatten(F.array(*[F.coalesce(t, F.array().cast("array<string>")) for t in texts]))
    each = df.select(F.col(id_col).alias("id"), F.filter(parts, lambda text: text.isNotNull()).alias("texts")).where("id IS NOT NULL")
    # A few rows of a table are many entries: tasks are as many as the entries ask for, rows are
    # spread before they become entries, and nothing is collected before the order is there.
    long = F.aggregate("texts", F.lit(0).cast("bigint"), lambda n, text: n + F.length(text) + 1)
    tasks = int((each.agg(F.coalesce(F.sum(long), F.lit(0))).first()[0]) // INDEX_ROWS) + 1
    each = each.repartition(tasks, "id", F.xxhash64("texts"))
    found = F.array_distinct(F.flatten(F.transform("texts", lambda text: entries(F.lower(text)))))
    grams = each.select("id", F.explode(found).alias("gram")).select("gram", "id")
    path = path or scratch_path(df.sparkSession, "component-index")
    # Equal entries, of rows with one id, lie in one task.
    grams = grams.repartitionByRange(tasks, "gram", "id").dropDuplicates(["gram", "id"])
    grams.sortWithinPartitions("gram", "id").write.parquet(path)
    return df.sparkSession.read.schema(grams.schema).parquet(path)


def search_components_indexed(
    df: DataFrame,
    index: DataFrame,
    query: str,
    cols: Sequence[str] = ("name", "type", "properties"),
    group_id=None,
    groups: DataFrame | None = None,
    id_col: str = "id",
) -> DataFrame:
    """As ``search_components``, from the components that the index names; each is tested literally.

    A text of GRAM letters or more is looked up by all its entries; a shorter one by the
    entries it is part of.
    """
    if not _given(query):
        raise ValueError("query is required")
    wanted = df.sparkSession.range(1).select(F.lower(F.lit(query.strip()))).first()[0]
    if len(wanted) >= GRAM:
        grams = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
        named = index.where(F.col("gram").isin(grams)).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
    else:
        named = index.where(F.contains("gram", F.lit(wanted))).select("id").distinct()
    candidates = lookup_join(df, named.select("id"), [(id_col, "id")], "left_semi")
    return search_components(candidates, query, cols, group_id, groups)
