"""Edges by name to ids, versioned changes, partial updates, emptied queues."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank_to_null, merge_maps
from millrace.operators.lookup import lookup_join
from millrace.operators.ordered import row_numbers
from millrace.session import cut_lineage, scratch_path

# Changes of a key that one transition stands for.
CHAIN_PIECE = 4096
# The state of a key that does not exist; one that does has its version.
ABSENT = -1


def look_up_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every edge with the ids of both ends, and whether both are ``resolved``.

    ``nodes`` has (pipeline_id, name, pos, id); of nodes with one name the last counts.
    """
    ids = nodes.groupBy("pipeline_id", "name").agg(F.max_by("id", "pos").alias("id"))
    found = edges
    for end in ("source", "destination"):
        on = [("pipeline_id", "pipeline_id"), (end, "name")]
        found = lookup_join(found, ids.withColumnRenamed("id", f"{end}_id"), on)
    both = F.col("source_id").isNotNull() & F.col("destination_id").isNotNull()
    return found.withColumn("resolved", both)


def resolve_edges(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with the ids of both ends, and the edges with an end that names no node.

    Unresolved edges keep the id that was found. ``look_up_edges`` gives both in one pass.
    """
    found = look_up_edges(edges, nodes)
    return found.where("resolved").drop("resolved"), found.where("NOT resolved").drop("resolved")


def apply_changes(
    current: DataFrame, changes: DataFrame, key: str = "id", rule: str = "first"
) -> tuple[DataFrame, DataFrame]:
    """Apply creates, updates and deletes under optimistic locking.

    ``current`` has ``key``, ``version`` and fields; ``changes`` has ``key``,
    ``seq`` (unique within a key), ``op``, ``sent_version`` and fields. Of the
    changes to one key the first by ``seq`` is tried: a create needs the key to
    be free, an update or delete the version that was sent. The others conflict,
    as do changes without a key, which name nothing. Returns the new table and the conflicting changes.

    With ``rule="sequence"`` each change sees the result of those before it, see ``apply_chains``.
    """
    if rule == "sequence":
        return apply_chains(current, changes, key)
    if rule != "first":
        raise ValueError("rule is 'first' or 'sequence'")
    fields = [c for c in current.columns if c not in (key, "version")]
    first = (
        changes.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(F.struct("seq", "op", "sent_version", *fields), "seq").alias("change"))
    )
    now = current.select(key, F.struct("version", *fields).alias("now"))
    both = now.join(first, key, "full_outer")
    op = F.col("change.op")
    accepted = F.coalesce(
        F.when(op == "create", F.col("now").isNull()).when(
            op.isin("update", "delete"),
            F.col("now").isNotNull() & (F.col("change.sent_version") == F.col("now.version")),
        ),
        F.lit(False),
    )
    judged = both.withColumn("accepted", accepted)
    replaced = F.col("accepted") & (op != "delete")
    version = F.when(op == "create", F.lit(0)).otherwise(F.col("now.version") + 1)
    table = judged.where(
        F.when(F.col("accepted"), op != "delete").otherwise(F.col("now").isNotNull())
    ).select(
        key,
        F.when(replaced, version).otherwise(F.col("now.version")).cast("bigint").alias("version"),
        *[
            F.when(replaced, F.col("change")[c]).otherwise(F.col("now")[c]).alias(c)
            for c in fields
        ],
    )
    # (key, seq) spreads the many changes to one key over tasks.
    taken = judged.where("accepted").select(key, F.col("change.seq").alias("seq"))
    conflicts = changes.join(taken, [key, "seq"], "left_anti").select(*changes.columns)
    return table, conflicts


def _moved(state: int, op: str, sent: int | None) -> int | None:
    """The state behind a change that is accepted in ``state``, else None."""
    if op == "create":
        return 0 if state == ABSENT else None
    if op not in ("update", "delete") or state == ABSENT or sent != state:
        return None
    return ABSENT if op == "delete" else state + 1


def _transition(rows: Iterable[tuple[str, int | None]]) -> dict[int, int]:
    """Where changes in order lead from each state that they move; they leave every other as it is.

    States that meet go on together, so each change is looked at once.
    """
    at: dict[int, list[int]] = {}  # state -> the states at the start that are in it by now
    begun: set[int] = set()
    for op, sent in rows:
        state = ABSENT if op == "create" else sent
        if state is None:
            continue
        if state not in begun and state not in at:
            # So far nothing has moved it.
            begun.add(state)
            at[state] = [state]
        elif state not in begun:
            begun.add(state)
            at[state].append(state)
        to = _moved(state, op, sent)
        if to is None or not at.get(state):
            continue
        moving, there = at.pop(state), at.get(to)
        if there is None:
            at[to] = moving
        else:
            small, large = sorted((moving, there), key=len)
            large.extend(small)
            at[to] = large
    return {start: state for state, starts in at.items() for start in starts if start != state}


def _piecewise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, piece, start, end) of each piece; pieces come one after the other, in order."""
    held: list[tuple] = []
    place = None

    def done() -> pd.DataFrame:
        moves = _transition(held)
        return pd.DataFrame({"k": place[0], "piece": place[1], "start": list(moves), "end": list(moves.values())})

    for batch in batches:
        sent = batch["sent"].astype("Int64").astype(object)
        for k, piece, op, value in zip(batch["k"], batch["piece"], batch["op"], sent, strict=True):
            if place != (k, piece):
                if held:
                    yield done()
                held, place = [], (k, piece)
            held.append((op, None if value is pd.NA else int(value)))
    if held:
        yield done()


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(k, number, accepted) of each change, from the state in front of its piece."""
    place = state = None
    for batch in batches:
        out, sent = [], batch["sent"].astype("Int64").astype(object)
        columns = (batch["k"], batch["piece"], batch["number"], batch["op"], sent, batch["state"])
        for k, piece, number, op, value, first in zip(*columns, strict=True):
            if place != (k, piece):
                place, state = (k, piece), int(first)
            to = _moved(state, op, None if value is pd.NA else int(value))
            out.append((k, number, to is not None))
            state = state if to is None else to
        yield pd.DataFrame(out, columns=["k", "number", "accepted"])


def _state(moves: DataFrame, at: DataFrame, end: Column) -> DataFrame:
    """``at`` (k, piece, state, ...) with the state behind the piece: moved, or as it was."""
    on = [("k", "k"), ("piece", "piece"), ("state", "start")]
    return lookup_join(at, moves.select("k", "piece", "start", end.alias("_end")), on).withColumn("state", F.coalesce("_end", "state")).drop("_end")


def apply_chains(current: DataFrame, changes: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Apply the changes to each key in order of ``seq``, each to the result of those before it.

    Arguments and results are those of ``apply_changes``; a change that is accepted replaces all
    fields. A change moves a key's state, which is its version or that it does not exist;
    what several changes do is again such a move. So the changes of a key are cut into pieces
    of CHAIN_PIECE, each becomes a table from state to state, neighbouring tables are joined
    pairwise until one is left, and the states in front of all pieces follow from the top
    down: rounds grow with the logarithm of the pieces, and no task holds a whole key.
    """
    spark = current.sparkSession
    fields = [c for c in current.columns if c not in (key, "version")]
    numbered = row_numbers(changes.where(F.col(key).isNotNull()), [key], ["seq"], "_number")
    path = scratch_path(spark, "changes")
    numbered = numbered.withColumn("_piece", F.floor((F.col("_number") - 1) / CHAIN_PIECE))
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    light = numbered.select(
        F.col(key).alias("k"), F.col("_piece").alias("piece"), F.col("_number").alias("number"), "op", F.col("sent_version").cast("bigint").alias("sent")
    )
    k_type = light.schema["k"].dataType.simpleString()
    in_pieces = lambda df: df.repartition("k", "piece").sortWithinPartitions("k", "piece", "number")
    moves, _, _ = cut_lineage(in_pieces(light).select("k", "piece", "op", "sent").mapInPandas(_piecewise, f"k {k_type}, piece bigint, start bigint, end bigint"))
    last = light.groupBy("k").agg(F.max("piece").alias("last"))
    most = last.agg(F.max("last")).first()[0] or 0

    # Upwards: a level's piece is two of the level below, the left one first.
    levels = [moves]
    for _ in range(int(most).bit_length()):
        below, half = levels[-1], F.floor(F.col("piece") / 2)
        left = below.where("piece % 2 = 0").select("k", half.alias("piece"), "start", F.col("end").alias("state"))
        right = below.where("piece % 2 = 1").select("k", half.alias("piece"), "start", "end")
        through = _state(right, left, F.col("end")).select("k", "piece", "start", F.col("state").alias("end"))
        only = right.join(left.select("k", "piece", "start"), ["k", "piece", "start"], "left_anti")
        levels.append(cut_lineage(through.unionByName(only).where("start != end"))[0])

    # Downwards: the state in front of each piece that has changes.
    now = current.select(F.col(key).alias("k"), F.col("version").alias("state"))
    front = lookup_join(last, now, "k").select("k", "last", F.lit(0).cast("bigint").alias("piece"), F.coalesce("state", F.lit(ABSENT).cast("bigint")).alias("state"))
    for level in range(len(levels) - 2, -1, -1):
        left = front.withColumn("piece", F.col("piece") * 2)
        right = _state(levels[level], left, F.col("end")).withColumn("piece", F.col("piece") + 1)
        wanted = F.col("piece") <= F.shiftright("last", level)
        front = cut_lineage(left.unionByName(right.select(*left.columns)).where(wanted))[0]

    judged = in_pieces(lookup_join(light, front.select("k", "piece", "state"), ["k", "piece"], "inner"))
    judged = judged.select("k", "piece", "number", "op", "sent", "state").mapInPandas(_judged, f"k {k_type}, number bigint, accepted boolean")
    verdict = lookup_join(numbered, cut_lineage(judged)[0], [(key, "k"), ("_number", "number")], "inner")
    accepted = verdict.where("accepted")
    # The last accepted change holds; updates since the last creation, or since the start, count the version.
    made = F.max(F.when(F.col("op") == "create", F.col("_number")))
    creation = accepted.groupBy(key).agg(made.alias("_created"), F.max_by(F.struct("op", *fields), "_number").alias("_last"))
    since = lookup_join(accepted.select(key, "_number", "op"), creation.select(key, "_created"), key, "inner")
    updates = since.where((F.col("op") == "update") & (F.col("_number") > F.coalesce("_created", F.lit(0)))).groupBy(key).agg(F.count("*").alias("_updates"))
    final = creation.join(updates, key, "left")
    both = current.select(key, F.struct("version", *fields).alias("_now")).join(final, key, "full_outer")
    base = F.when(F.col("_created").isNotNull(), F.lit(0)).otherwise(F.col("_now.version"))
    changed = F.col("_last").isNotNull()
    table = both.where(~changed | (F.col("_last.op") != "delete")).select(
        key,
        F.when(changed, base + F.coalesce("_updates", F.lit(0))).otherwise(F.col("_now.version")).cast("bigint").alias("version"),
        *[F.when(changed, F.col("_last")[c]).otherwise(F.col("_now")[c]).alias(c) for c in fields],
    )
    conflicts = verdict.where("NOT accepted").select(*changes.columns).unionByName(changes.where(F.col(key).isNull()))
    return table, conflicts


def patch(
    current: DataFrame,
    changes: DataFrame,
    cols: Sequence[str],
    key: str = "id",
    map_cols: Sequence[str] = (),
) -> DataFrame:
    """Change only the fields that were given; ``changes`` has one row for each key.

    Blank texts count as not given. ``map_cols`` are merged, the new value winning.
    """
    types = {c: dict(changes.dtypes)[c] for c in cols}
    given = [
        (blank_to_null(c) if types[c] == "string" else F.col(c)).alias(f"_new_{c}") for c in cols
    ] + [F.col(c).alias(f"_new_{c}") for c in map_cols]
    joined = current.join(changes.select(key, *given), key, "left")
    patched = {c: F.coalesce(f"_new_{c}", c) for c in cols}
    patched |= {c: merge_maps(F.col(c), F.col(f"_new_{c}")) for c in map_cols}
    return joined.withColumns(patched).select(*current.columns)


def empty_queue(
    queue: DataFrame, connection_ids: Iterable[str] | DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The rows kept, and for each emptied connection the dropped count and bytes."""
    if isinstance(connection_ids, DataFrame):
        ids = connection_ids.select("connection_id").distinct()
        kept = lookup_join(queue, ids, "connection_id", "left_anti")
        dropped = lookup_join(queue, ids, "connection_id", "left_semi")
    else:
        chosen = F.coalesce(F.col("connection_id").isin(list(connection_ids)), F.lit(False))
        kept, dropped = queue.where(~chosen), queue.where(chosen)
    return kept, dropped.groupBy("connection_id").agg(
        F.count("*").alias("dropped_count"), F.sum("size_bytes").alias("dropped_bytes")
    )
