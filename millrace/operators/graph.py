"""Trees and lineage: descendants, roll-ups, one FlowFile's path, transitive closure.

A closure doubles its reach in each round, a forest's labels the length of their jumps, so
rounds grow with the logarithm of the depth; other loops run once for each level, never
once for each row. What a round finds is cut off from the plan in the shared folder and
measured. A small side is broadcast; a larger one is joined on its key, where hot keys are
split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup_join
from millrace.operators.ordered import next_rows
from millrace.session import cut_lineage, fits_broadcast

# Rounds of a roll-up after which a cycle is looked for.
SUSPICIOUS_ROUNDS = 32
# Jumps for each edge and reached pair beyond which a closure goes on level by level.
JUMP_GROWTH = 4
# Places of a forest's tour that are added up in one window.
TOUR_SLICE = 100_000


def _levels(
    edges: DataFrame, start: DataFrame, max_depth: int | None, reached: DataFrame | None = None, depth: int = 0
) -> DataFrame:
    """Breadth-first levels from ``start`` (seed, node, depth), all at ``depth``, with what is ``reached`` already.

    Every (seed, node) is kept at its first depth, so cycles end. New pairs are told
    from known ones by the one aggregate that also removes repeats.
    """
    frontier, rows, size = cut_lineage(start)
    reached = frontier if reached is None else reached
    while rows and (max_depth is None or depth < max_depth):
        depth += 1
        if fits_broadcast(rows, size):
            frontier = F.broadcast(frontier)
        step = edges.join(frontier, edges["src"] == frontier["node"]).select(
            "seed",
            F.col("dst").alias("node"),
            F.lit(depth).alias("depth"),
        )
        new = (
            step.unionByName(reached)
            .groupBy("seed", "node")
            .agg(F.min("depth").alias("depth"))
            .where(F.col("depth") == depth)
        )
        frontier, rows, size = cut_lineage(new)
        if rows:
            reached = reached.unionByName(frontier)
    return reached


def lineage_closure(
    edges: DataFrame,
    seeds: DataFrame,
    direction: str = "down",
    max_depth: int | None = None,
) -> DataFrame:
    """All nodes reachable from each seed, with the fewest steps, as (seed, node, depth).

    ``edges`` is (src, dst), ``seeds`` is (seed). ``direction`` is ``down`` or ``up``.
    The seed itself is included at depth 0.

    Each round joins what is reached within fewer than n steps with the jumps of exactly n,
    adds the pairs that are new and joins the jumps with themselves, so a path of any length
    takes a logarithm of rounds. Where jumps become many more than edges, as in a dense
    graph, the rest is followed level by level.
    """
    if direction not in ("down", "up"):
        raise ValueError("direction is 'down' or 'up'")
    src, dst = ("src", "dst") if direction == "down" else ("dst", "src")
    steps = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    start = seeds.select("seed").distinct().select(
        "seed", F.col("seed").alias("node"), F.lit(0).alias("depth")
    )
    reached, n_reached, size = cut_lineage(start)
    jumps, n_edges, jump_size = cut_lineage(steps.where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    n_jumps, length = n_edges, 1
    while n_reached and n_jumps and (max_depth is None or length <= max_depth):
        if n_jumps > JUMP_GROWTH * (n_edges + n_reached):
            last = reached.where(F.col("depth") == length - 1)
            return _levels(steps, last, max_depth, reached, length - 1)
        far = F.broadcast(jumps) if fits_broadcast(n_jumps, jump_size) else jumps
        step = reached.join(far, F.col("node") == F.col("src")).select("seed", F.col("dst").alias("node"), (F.col("depth") + length).alias("depth"))
        if max_depth is not None:
            step = step.where(F.col("depth") <= max_depth)
        new = step.groupBy("seed", "node").agg(F.min("depth").alias("depth")).join(reached, ["seed", "node"], "left_anti")
        new, found, _ = cut_lineage(new)
        if not found:
            break
        reached, n_reached = reached.unionByName(new), n_reached + found
        length *= 2
        if max_depth is None or length <= max_depth:
            behind = far.select(F.col("src").alias("dst"), F.col("dst").alias("end"))
            jumps, n_jumps, jump_size = cut_lineage(jumps.join(behind, "dst").select("src", F.col("end").alias("dst")).distinct())
    return reached


def subtree(groups: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """A group and all groups nested in it, with depth."""
    edges = groups.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("src"), F.col("group_id").alias("dst")
    )
    start = groups.where(F.col("group_id") == root).select(F.col("group_id").alias("seed"))
    reached = lineage_closure(edges, start, "down", max_depth)
    return groups.join(
        reached.select(F.col("node").alias("group_id"), "depth"), "group_id"
    ).select(*groups.columns, "depth")


def _check_acyclic(groups: DataFrame) -> None:
    """Groups that no root leads to are in a cycle or below one."""
    known = groups.select(F.col("group_id").alias("parent_id"))
    roots = groups.join(known, "parent_id", "left_anti").select(F.col("group_id").alias("root"))
    tops = roots.select(F.lit(0).alias("seed"), F.col("root").alias("node"), F.lit(0).alias("depth"))
    edges = groups.select(F.col("parent_id").alias("src"), F.col("group_id").alias("dst"))
    reached = _levels(edges, tops, None).select("node").distinct()
    if groups.join(reached, groups["group_id"] == reached["node"], "left_anti").limit(1).count():
        raise ValueError("groups are nested in a cycle")


def rollup(groups: DataFrame, measures: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sums of ``cols`` for each group over itself and all nested groups.

    Measures move up one level in each round and are added up before they move
    on, so no (ancestor, descendant) pair is ever written. Any depth is followed; groups
    nested in a cycle are refused, which is looked into once after many rounds.
    """
    parents = groups.select("group_id", "parent_id")
    sums = [F.sum(c).alias(c) for c in cols]
    level, rows, _ = cut_lineage(measures.groupBy("group_id").agg(*sums))
    levels = level
    rounds = 0
    while rows:
        rounds += 1
        if rounds == SUSPICIOUS_ROUNDS:
            _check_acyclic(groups)
        moved = (
            level.join(parents.where(F.col("parent_id").isNotNull()), "group_id")
            .groupBy(F.col("parent_id").alias("group_id"))
            .agg(*sums)
        )
        level, rows, _ = cut_lineage(moved)
        if rows:
            levels = levels.unionByName(level)
    totals = levels.groupBy("group_id").agg(*sums)
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in cols]
    return groups.select("group_id").join(totals, "group_id", "left").select("group_id", *zero)


def interval_labels(groups: DataFrame) -> DataFrame:
    """``groups`` with enter, leave and level, the places of each group in a tour of the forest.

    The tour enters a group, tours its children in order of their id and leaves it; a group
    is nested in another if its places lie between the other's. Groups without a parent, or
    with one that is not there, are roots. Each place learns how far it is from the end by
    pointer doubling: rounds grow with the logarithm of the number of groups, whatever the
    depth. Groups nested in a cycle are refused.
    """
    ids = groups.select(F.col("group_id").alias("parent_id"))
    known = lookup_join(groups.select("group_id", "parent_id"), ids.withColumn("is_known", F.lit(True)), "parent_id")
    # All roots are children of one, which is null in a struct.
    family = known.select("group_id", F.struct(F.when(F.col("is_known"), F.col("parent_id")).alias("id")).alias("parent"))
    siblings = next_rows(family, ["parent"], ["group_id"], F.col("group_id"), "sibling")
    first = family.where("parent.id IS NOT NULL").groupBy(F.col("parent.id").alias("parent_id")).agg(F.min("group_id").alias("child"))
    tree = lookup_join(siblings, first, [("group_id", "parent_id")])
    place = lambda group, leaving: F.struct(group.alias("id"), F.lit(leaving).alias("leaving"))
    group, child, sibling, parent = F.col("group_id"), F.col("child"), F.col("sibling"), F.col("parent.id")
    entering = F.when(child.isNotNull(), place(child, False)).otherwise(place(group, True))
    leaving = F.when(sibling.isNotNull(), place(sibling, False)).when(parent.isNotNull(), place(parent, True))
    tour = tree.select(
        F.explode(
            F.array(
                F.struct(place(group, False).alias("at"), entering.alias("to"), F.lit(1).cast("bigint").alias("hops"), F.lit(1).cast("bigint").alias("balance")),
                F.struct(place(group, True).alias("at"), leaving.alias("to"), F.lit(1).cast("bigint").alias("hops"), F.lit(-1).cast("bigint").alias("balance")),
            )
        ).alias("place")
    ).select("place.*")
    tour, places, _ = cut_lineage(tour)
    for _ in range(max(1, places).bit_length()):
        further = tour.select(F.col("at").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("balance").alias("rest"))
        tour, _, _ = cut_lineage(
            lookup_join(tour.withColumn("key", F.col("to")), further, [("key", "to")]).select(
                "at",
                F.col("next").alias("to"),
                (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
                (F.col("balance") + F.coalesce("rest", F.lit(0))).alias("balance"),
            )
        )
    if tour.where(F.col("to").isNotNull()).limit(1).count():
        raise ValueError("groups are nested in a cycle")
    at = F.lit(places) - F.col("hops")
    labels = tour.groupBy(F.col("at.id").alias("group_id")).agg(
        F.max(F.when(~F.col("at.leaving"), at)).alias("enter"),
        F.max(F.when(F.col("at.leaving"), at)).alias("leave"),
        F.max(F.when(~F.col("at.leaving"), -F.col("balance"))).cast("int").alias("level"),
    )
    return groups.join(labels, "group_id").select(*groups.columns, "enter", "leave", "level")


def subtree_of(labels: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """As ``subtree`` from a table of ``interval_labels``: one range of places, read by a filter."""
    bounds = labels.where(F.col("group_id") == root).select("enter", "leave", "level").first()
    enter, leave, level = bounds or (0, -1, 0)
    found = labels.where(F.col("enter").between(enter, leave))
    if max_depth is not None:
        found = found.where(F.col("level") <= level + max_depth)
    columns = [c for c in labels.columns if c not in ("enter", "leave", "level")]
    return found.select(*columns, (F.col("level") - level).cast("int").alias("depth"))


def rollup_of(labels: DataFrame, measures: DataFrame, cols: Sequence[str]) -> DataFrame:
    """As ``rollup`` from a table of ``interval_labels``, in a fixed number of shuffles for any depth.

    What lies between the places of a group is the difference of two running sums along the
    tour, so ``cols`` should be whole numbers or decimals.
    """
    sums = measures.groupBy("group_id").agg(*[F.sum(c).alias(c) for c in cols])
    own = lookup_join(labels.select("group_id", "enter", "leave"), sums, "group_id")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in cols]
    places = own.select(
        "group_id",
        *zero,
        F.explode(F.array(F.struct(F.col("enter").alias("at"), F.lit(1).alias("side")), F.struct(F.col("leave").alias("at"), F.lit(0).alias("side")))).alias("p"),
    ).select("group_id", "p.at", "p.side", F.floor(F.col("p.at") / TOUR_SLICE).alias("slice"), *[(F.col(c) * F.col("p.side")).alias(c) for c in cols])
    # One row for each TOUR_SLICE places carries the sums from slice to slice.
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = places.groupBy("slice").agg(*[F.sum(c).alias(c) for c in cols])
    carried = totals.select("slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in cols])
    within = Window.partitionBy("slice").orderBy("at")
    running = places.select("group_id", "slice", "side", *cols, *[F.sum(c).over(within).alias(f"_run_{c}") for c in cols]).join(carried, "slice")
    # Behind the last place less in front of the first.
    part = lambda c: F.when(F.col("side") == 0, F.col(f"_run_{c}") + F.col(f"_{c}")).otherwise(F.col(c) - F.col(f"_run_{c}") - F.col(f"_{c}"))
    return running.groupBy("group_id").agg(*[F.sum(part(c)).alias(c) for c in cols])


def flowfile_lineage(
    events: DataFrame, event_id, slice_by: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The events of the FlowFile of one event, and the edges from each to the next.

    The FlowFile is looked up in a scalar subquery, whose result is pushed to the
    scan. Events are ordered by (ts, event_id).
    """
    # Of an event id that occurs more than once the largest FlowFile, whatever is read first.
    of_event = events.where(F.col("event_id") == event_id).agg(F.max("flowfile_uuid"))
    nodes = events.where(F.col("flowfile_uuid") == of_event.scalar())
    edges = (
        next_rows(
            nodes.select("flowfile_uuid", "ts", "event_id"),
            ["flowfile_uuid"],
            ["ts", "event_id"],
            F.col("event_id"),
            "to_event",
            slice_by,
        )
        .where(F.col("to_event").isNotNull())
        .select("flowfile_uuid", F.col("event_id").alias("from_event"), "to_event")
    )
    return nodes, edges
