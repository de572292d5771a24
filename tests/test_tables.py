"""Parameters, changes, graphs, ordered rows and monitoring on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, graph, monitor, ordered, params, records, routing


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# Parameters

PARAMS = "context string, name string, value string"


def test_substitution_is_one_pass(spark):
    values = frame(
        spark, PARAMS,
        ("c", "x", "#{y}"), ("c", "y", "2"), ("c", "money", "$1 \\ {}"), ("other", "z", "no"),
    )
    texts = frame(
        spark, "id int, context string, text string",
        (1, "c", "#{x}"), (2, "c", "a#{y}b#{x}#{z}c"), (3, "c", "plain #{} #y"), (4, None, "#{y}"),
        (5, "c", None), (6, "c", "#{money}#{money}"), (7, "c", ""), (8, "c", "#{y}"), (9, "c", "#{y}"),
    )
    found = params.substitute(texts, "text", values, "context")
    assert found.columns == ["id", "context", "text", "unresolved"]
    assert rows(found, "id", "text", "unresolved") == [
        (1, "#{y}", []),
        (2, "a2b#{y}#{z}c", ["z"]),
        (3, "plain #{} #y", []),
        (4, "#{y}", ["y"]),
        (5, None, None),
        (6, "$1 \\ {}$1 \\ {}", []),
        (7, "", []),
        (8, "2", []),
        (9, "2", []),
    ]


def test_null_parameter_value_keeps_the_reference(spark):
    values = frame(spark, PARAMS, ("c", "x", None))
    texts = frame(spark, "context string, text string", ("c", "<#{x}>"))
    found = params.substitute(texts, "text", values, "context")
    assert rows(found, "text", "unresolved") == [("<#{x}>", [])]


def test_repeated_and_nameless_parameters_have_one_rule(spark):
    values = frame(spark, PARAMS, ("c", "x", "2"), ("c", "x", "1"), ("c", None, "3"), (None, "x", "4"), ("c", "unused", "5"), ("c", "unused", "6"))
    texts = frame(spark, "context string, text string", ("c", "<#{x}>"), (None, "#{x}"))
    found = params.substitute(texts, "text", values, "context")
    assert rows(found, "text", "unresolved") == [("#{x}", ["x"]), ("<1>", [])]


def test_parameter_sets_as_json(spark):
    texts = frame(
        spark, "c string, seq bigint, text string",
        ("c", 1, '{"a":"1","b":{"value":"2","sensitive":true,"description":"about"},"n":3,"e":{}}'),
        ("c", 2, "[1]"), ("c", 3, "broken"), ("c", 4, " "), ("c", 5, None),
    )
    found, rejects = params.parse_parameter_entries(texts, "c", "text")
    assert rows(found, "context", "seq", "name", "value", "sensitive", "description") == [
        ("c", 1, "a", "1", False, None), ("c", 1, "b", "2", True, "about"), ("c", 1, "e", "", False, None), ("c", 1, "n", "3", False, None),
    ]
    assert rows(rejects, "seq", "reason") == [(2, params.REASON_NOT_ENTRIES), (3, params.REASON_NOT_ENTRIES)]


def test_removal_beats_set(spark):
    current = frame(spark, PARAMS, ("c", "a", "1"), ("c", "b", "2"), ("c", "keep", "3"))
    sets = frame(
        spark, PARAMS + ", seq bigint",
        ("c", "a", "9", 2), ("c", "a", "8", 1), ("c", "b", "7", -5), ("c", "gone", "6", 4),
    )
    removals = frame(spark, "context string, name string", ("c", "gone"), ("c", "unknown"))
    assert rows(params.apply_params(current, sets, removals)) == [
        ("c", "a", "9"), ("c", "b", "7"), ("c", "keep", "3"),
    ]


def test_nearest_level_then_lowest_rank_wins(spark):
    values = frame(
        spark, PARAMS + ", sensitive boolean",
        ("low", "p", "from low", False), ("high", "p", "from high", False),
        ("far", "p", "far", False), ("far", "q", "far", True), ("own", "r", "own", False),
    )
    inherits = frame(
        spark, "child string, parent string, rank int",
        ("own", "high", 2), ("own", "low", 1), ("low", "far", 1), ("far", "own", 1),
    )
    found = params.inherited_params(values, inherits).where("context = 'own'")
    assert rows(found, "name", "value", "origin", "depth") == [
        ("p", "from low", "low", 1), ("q", "far", "far", 2), ("r", "own", "own", 0),
    ]


# Changes

TABLE = "id string, version bigint, name string"
CHANGES = "id string, seq bigint, op string, sent_version bigint, name string"


def test_versioned_changes(spark):
    current = frame(
        spark, TABLE, ("a", 3, "a"), ("b", 0, "b"), ("c", 5, "c"), ("d", 1, "d"), ("e", 0, None)
    )
    batch = frame(
        spark, CHANGES,
        ("a", 1, "update", 3, "a1"), ("a", 2, "update", 3, "late"),      # second conflicts
        ("b", 5, "delete", 0, None), ("b", 6, "update", 0, "gone"),      # update after delete
        ("c", 1, "update", 4, "stale"),                                  # wrong version
        ("d", 1, "create", 0, "exists"),                                 # create of existing
        ("f", 1, "create", 0, "f"), ("g", 1, "update", 0, "nobody"),
        ("e", 1, "update", None, "no version"),
    )
    table, conflicts = changes.apply_changes(current, batch)
    assert rows(table) == [
        ("a", 4, "a1"), ("c", 5, "c"), ("d", 1, "d"), ("e", 0, None), ("f", 0, "f"),
    ]
    assert rows(conflicts, "id", "seq") == [
        ("a", 2), ("b", 6), ("c", 1), ("d", 1), ("e", 1), ("g", 1),
    ]
    untouched, none = changes.apply_changes(current, batch.limit(0))
    assert rows(untouched) == rows(current) and none.isEmpty()


def test_patch_changes_only_given_fields(spark):
    current = frame(
        spark, "id string, name string, n int, props map<string,string>",
        ("a", "x", 1, {"k": "1", "j": "2"}), ("b", "y", 2, None),
    )
    given = frame(
        spark, "id string, name string, n int, props map<string,string>",
        ("a", " ", 5, {"k": "9"}), ("c", "z", 1, None),
    )
    found = changes.patch(current, given, ["name", "n"], map_cols=["props"])
    assert sorted(map(tuple, found.collect())) == [
        ("a", "x", 5, {"j": "2", "k": "9"}), ("b", "y", 2, {}),
    ]


def test_last_node_of_a_name_counts(spark):
    nodes = frame(
        spark, "pipeline_id string, name string, pos int, id string",
        ("p", "a", 0, "1"), ("p", "a", 2, "3"), ("p", "b", 1, "2"), ("q", "c", 0, "4"),
    )
    edges = frame(
        spark, "pipeline_id string, source string, destination string",
        ("p", "a", "b"), ("p", "b", "c"), ("q", "c", "c"),
    )
    resolved, unresolved = changes.resolve_edges(edges, nodes)
    assert rows(resolved, "source_id", "destination_id") == [("3", "2"), ("4", "4")]
    assert rows(unresolved, "source", "source_id", "destination_id") == [("b", "2", None)]


def test_emptied_queue_by_table_and_by_list(spark):
    queue = frame(
        spark, "connection_id string, size_bytes bigint", ("a", 1), ("a", 2), ("b", 4), (None, 8)
    )
    ids = frame(spark, "connection_id string", ("a",), ("a",))
    for chosen in (["a"], ids):
        kept, dropped = changes.empty_queue(queue, chosen)
        assert rows(kept) == [("b", 4), (None, 8)]
        assert rows(dropped) == [("a", 2, 3)]


# Graphs

def brute_closure(edges, seeds, limit=None):
    found = set()
    for seed in seeds:
        level, seen, depth = {seed}, set(), 0
        while level:
            found |= {(seed, node, depth) for node in level}
            seen |= level
            level = {b for a, b in edges if a in level} - seen
            depth += 1
            if limit is not None and depth > limit:
                break
    return found


@pytest.mark.parametrize("small", [True, False])
def test_closure_with_cycles_and_many_seeds(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(graph, "fits_broadcast", lambda rows, size: False)
    rng = random.Random(5)
    edges = {(f"n{rng.randrange(20)}", f"n{rng.randrange(20)}") for _ in range(25)}
    edges |= {("hub", f"n{i}") for i in range(20)}
    df = frame(spark, "src string, dst string", *edges, *list(edges)[:5])
    seeds = frame(spark, "seed string", ("hub",), ("n1",), ("n1",), ("n2",), ("alone",))
    names = {"hub", "n1", "n2", "alone"}
    assert set(rows(graph.lineage_closure(df, seeds))) == brute_closure(edges, names)
    up = {(b, a) for a, b in edges}
    assert set(rows(graph.lineage_closure(df, seeds, "up", 2))) == brute_closure(up, names, 2)


GROUPS = "group_id string, parent_id string, name string"


def test_subtree_and_rollup(spark):
    groups = frame(
        spark, GROUPS, ("root", None, "r"), ("a", "root", "a"), ("b", "root", "b"), ("c", "a", "c")
    )
    assert rows(graph.subtree(groups, "a"), "group_id", "depth") == [("a", 0), ("c", 1)]
    measures = frame(spark, "group_id string, n bigint", ("c", 1), ("c", 2), ("b", 5), ("root", 10))
    assert rows(graph.rollup(groups, measures, ["n"])) == [
        ("a", 3), ("b", 5), ("c", 3), ("root", 18),
    ]


def test_rollup_over_a_cycle_is_refused(spark):
    groups = frame(spark, GROUPS, ("a", "b", "a"), ("b", "a", "b"))
    measures = frame(spark, "group_id string, n bigint", ("a", 1))
    with pytest.raises(ValueError, match="cycle"):
        graph.rollup(groups, measures, ["n"])


def test_deep_chains_are_followed_to_the_end(spark):
    n = 150
    groups = frame(spark, GROUPS, *[(f"g{i}", f"g{i - 1}" if i else None, "x") for i in range(n)])
    measures = frame(spark, "group_id string, n bigint", (f"g{n - 1}", 7))
    assert rows(graph.rollup(groups, measures, ["n"])) == sorted((f"g{i}", 7) for i in range(n))


def test_a_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    n, rounds = 10_000, []
    plain = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: rounds.append(1) or plain(df))
    edges = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = graph.lineage_closure(edges, frame(spark, "seed bigint", (0,)))
    assert found.agg(F.count("*"), F.max("depth"), F.sum("depth")).first() == (n + 1, n, n * (n + 1) // 2)
    # Two tables are cut in a round, of pairs and of jumps, and two before the first.
    assert len(rounds) <= 2 * 15 + 2
    up = graph.lineage_closure(edges, frame(spark, "seed bigint", (n,), (5,)), "up", 100)
    assert up.groupBy("seed").agg(F.max("depth")).orderBy("seed").collect() == [(5, 5), (n, 100)]


def test_dense_graph_goes_on_by_levels(spark, monkeypatch):
    monkeypatch.setattr(graph, "JUMP_GROWTH", 0)
    rng = random.Random(8)
    edges = {(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(60)}
    found = graph.lineage_closure(frame(spark, "src string, dst string", *edges), frame(spark, "seed string", ("n1",), ("n2",)))
    assert set(rows(found)) == brute_closure(edges, {"n1", "n2"})


def test_interval_labels_of_a_forest(spark):
    rng = random.Random(2)
    parent = {f"g{i}": f"g{rng.randrange(i)}" if i % 9 else None for i in range(120)} | {"orphan": "gone", "under": "orphan"}
    parent |= {f"d{i}": f"d{i - 1}" if i else "g5" for i in range(60)}
    groups = frame(spark, GROUPS, *[(g, p, g.upper()) for g, p in parent.items()])
    labels = graph.interval_labels(groups).cache()

    def under(group):
        found, depth = {group: 0}, 0
        while any(p in found and g not in found for g, p in parent.items()):
            depth += 1
            found |= {g: depth for g, p in parent.items() if found.get(p) == depth - 1 and g not in found}
        return found

    for root in ("g0", "g5", "d59", "orphan"):
        assert {r.group_id: r.depth for r in graph.subtree_of(labels, root).collect()} == under(root)
    assert {r.group_id for r in graph.subtree_of(labels, "d0", 2).collect()} == {"d0", "d1", "d2"}
    assert graph.subtree_of(labels, "nobody").count() == 0
    measures = frame(spark, "group_id string, n bigint", *[(g, rng.randint(1, 9)) for g in parent], ("g7", 100), ("g7", None), ("nobody", 5))
    own = {g: sum(r.n or 0 for r in measures.where(F.col("group_id") == g).collect()) for g in ("g0", "d30")}
    totals = {r.group_id: r.n for r in graph.rollup_of(labels, measures, ["n"]).collect()}
    plain = {r.group_id: r.n for r in graph.rollup(groups, measures, ["n"]).collect()}
    assert totals == plain and totals.keys() == parent.keys() and totals["g0"] > own["g0"] and totals["d30"] > own["d30"]
    places = sorted(x for r in labels.collect() for x in (r.enter, r.leave))
    assert places == list(range(2 * len(parent)))
    for cycle in ([("a", "b", "a"), ("b", "a", "b")], [("a", None, "a"), ("x", "y", "x"), ("y", "z", "y"), ("z", "x", "z"), ("w", "x", "w")]):
        with pytest.raises(ValueError, match="cycle"):
            graph.interval_labels(frame(spark, GROUPS, *cycle))


def chain_by_hand(current, changes):
    state = {k: (v, name) for k, v, name in current}
    conflicts = []
    for k, seq, op, sent, name in sorted((c for c in changes if c[0] is not None), key=lambda c: (c[0], c[1])):
        now = state.get(k)
        if op == "create" and now is None:
            state[k] = (0, name)
        elif op == "update" and now is not None and sent == now[0]:
            state[k] = (now[0] + 1, name)
        elif op == "delete" and now is not None and sent == now[0]:
            del state[k]
        else:
            conflicts.append(seq)
    return sorted((k, *v) for k, v in state.items()), sorted(conflicts + [c[1] for c in changes if c[0] is None])


@pytest.mark.parametrize("piece", [4096, 7])
def test_chains_of_changes(spark, monkeypatch, piece):
    """A key with hundreds of changes in pieces, versions that rise, creation behind deletion, changes that fit nothing."""
    monkeypatch.setattr(changes, "CHAIN_PIECE", piece)
    rng = random.Random(4)
    current = [(k, rng.choice([0, 3]), f"c{k}") for k in range(0, 12, 2)] + [(100, 7, "untouched")]
    asked, version, seq = [], {}, 0
    for _ in range(900):
        k = rng.choice([0, 0, 0, 0, 1, 2, 3, 4, 5, 6, 20, None])
        seq += rng.randint(1, 3)
        op = rng.choice(["update"] * 12 + ["delete", "create", "other", None])
        # Mostly the version that the key has by now, so that chains grow.
        at = version.setdefault(k, next((c[1] for c in current if c[0] == k), -1))
        sent = rng.choice([at, at, at, at, 0, 1, None])
        version[k] = 0 if op == "create" and at < 0 else at + 1 if op == "update" and sent == at and at >= 0 else -1 if op == "delete" and sent == at and at >= 0 else at
        asked.append((k, seq, op, sent, f"n{seq}"))
    table, conflicts = changes.apply_changes(
        frame(spark, "id bigint, version bigint, name string", *current),
        frame(spark, "id bigint, seq bigint, op string, sent_version bigint, name string", *rng.sample(asked, len(asked))),
        rule="sequence",
    )
    want, refused = chain_by_hand(current, asked)
    assert sorted(tuple(r) for r in table.collect()) == want
    assert sorted(r.seq for r in conflicts.collect()) == refused
    assert max(v for _, v, _ in want) > 20
    with pytest.raises(ValueError, match="rule"):
        changes.apply_changes(table, conflicts, rule="other")


def test_a_piece_moves_states_as_its_changes_do():
    rng = random.Random(9)
    for _ in range(300):
        asked = [(rng.choice(["create", "update", "update", "delete"]), rng.choice([None, 0, 1, 2, 3])) for _ in range(rng.randint(0, 12))]
        moves = changes._transition(asked)
        for start in range(-1, 8):
            state = start
            for op, sent in asked:
                to = changes._moved(state, op, sent)
                state = state if to is None else to
            assert moves.get(start, start) == state


# Ordered rows

def test_numbers_and_next_rows_across_slices(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 7}", i, rng.randrange(10**7)) for i in range(600)]
    data += [(None, 1000 + i, rng.randrange(10**7)) for i in range(10)]
    df = frame(spark, "key string, id int, at bigint", *data)
    expected_numbers, expected_next = set(), set()
    for key in {k for k, _, _ in data}:
        line = [i for _, i in sorted((at, i) for k, i, at in data if k == key)]
        expected_numbers |= {(i, n + 1) for n, i in enumerate(line)}
        expected_next |= set(zip(line, [*line[1:], None]))
    numbered = ordered.row_numbers(df, ["key"], ["at", "id"])
    assert set(rows(numbered, "id", "row_number")) == expected_numbers
    led = ordered.next_rows(df, ["key"], ["at", "id"], F.col("id"))
    assert set(rows(led, "id", "next")) == expected_next


def test_measured_slices_of_any_type(spark, monkeypatch):
    """A text order with nulls and ties, one hour with all rows of a key: slices are alike, numbers are those of the order."""
    rng = random.Random(3)
    data = [("hot", rng.choice(["a", "b", None, "c" * rng.randint(1, 3)]), "2024-01-01 05:00:00", i) for i in range(3000)]
    data += [(f"k{i % 7}", str(rng.random()), "2024-01-01 05:00:00", i) for i in range(200)] + [(None, None, None, 1)]
    df = frame(spark, "key string, word string, ts string, id int", *data).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for order in (["word", "id"], ["ts", "id"]):
            found = ordered.row_numbers(df, ["key"], order, "n")
            got = {(r.key, r.word, r.ts, r.id): r.n for r in found.collect()}
            wanted = {}
            low = lambda row: [(x is not None, x) for x in (row[1 if order[0] == "word" else 2], row[3])]
            for key in {d[0] for d in data}:
                for n, row in enumerate(sorted((d for d in data if d[0] == key), key=low), 1):
                    wanted[row] = n
            assert got == wanted
        groups = ordered._sliced(df, ["key"], ["ts"], None).where("key = 'hot'").groupBy("_group").count().collect()
        assert len(groups) >= 4 and max(g["count"] for g in groups) < 1500
        summed = ordered.running_sums(df.where("key = 'hot'"), ["key"], ["id"], "id").collect()
        assert {r.id: r.running for r in summed} == {i: i * (i + 1) // 2 for i in range(3000)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_null_next_value_is_not_taken_for_a_missing_row(spark):
    df = frame(spark, "k int, at int, v string", (1, 1, "a"), (1, 2, None), (1, 300_000, "c"))
    led = ordered.next_rows(df, ["k"], ["at"], F.coalesce("v", F.lit("none")))
    assert rows(led, "at", "next") == [(1, "none"), (2, "c"), (300_000, None)]


def test_batches(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    sizes = records.split_records(df, "k", "id", 300).groupBy("k", "batch").count()
    assert rows(sizes) == [(0, 0, 300), (0, 1, 200), (1, 0, 300), (1, 1, 200)]


# Monitoring

def test_search_arguments(spark):
    events = frame(
        spark,
        "event_id bigint, ts timestamp, processor_id string, component_type string, flowfile_uuid string",
    )
    for wrong in (0, -1, "5"):
        with pytest.raises(ValueError):
            monitor.provenance_search(events, max_results=wrong)
    with pytest.raises(ValueError):
        monitor.search_components(events, "  ")


def test_blank_filters_do_not_count_and_ends_are_inclusive(spark):
    events = frame(
        spark, "event_id bigint, ts string, processor_id string, component_type string, flowfile_uuid string",
        (1, "2024-01-01 00:00:00", "p", "A", "u"), (2, "2024-01-02 00:00:00", "p", "A", "u"),
        (3, "2024-01-02 00:00:00", "q", "A", "u"), (4, "2024-01-03 00:00:00", "p", "B", "u"),
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    found = monitor.provenance_search(
        events, processor_id=" ", flowfile_uuid="u", start="2024-01-02", end="2024-01-02"
    )
    assert [r.event_id for r in found.collect()] == [3, 2]
    newest = monitor.provenance_search(events, max_results=2)
    assert [r.event_id for r in newest.collect()] == [4, 3]


@pytest.mark.parametrize("offset", [0, 5, 95, 1400, 2780, 2990, 4000])
def test_pages_at_any_depth(spark, monkeypatch, offset):
    """Most rows have one time, some none; no look into a range holds more than it."""
    rng = random.Random(7)
    data = [(i, rng.choice(["2024-01-01 00:00:00"] * 5 + [None, f"2024-01-0{rng.randint(1, 9)} 00:00:00"]), i % 3) for i in range(3000)]
    df = frame(spark, "action_id int, ts string, source_id int", *data).withColumn("ts", F.col("ts").cast("timestamp"))
    wanted = [r.action_id for r in df.orderBy(F.desc("ts"), F.desc("action_id")).collect()][offset : offset + 40]
    monkeypatch.setattr(monitor, "PAGE_ROWS", 100)
    found = monitor.history(df, limit=40, offset=offset)
    assert [r.action_id for r in found.collect()] == wanted
    if 100 < offset < 2900:
        # What is left to be sorted does not grow with the offset.
        left = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" in left and int(left.split("Offset ")[1].split("\n")[0]) < 400


def test_index_of_repeated_ids_in_many_tasks(spark, monkeypatch):
    """Each entry once, in order, in as many tasks as there are entries for; no id, no entry."""
    monkeypatch.setattr(monitor, "INDEX_ROWS", 50)
    data = [(i % 7 if i % 11 else None, f"Name {i % 3}", "abab", {"k": "v" * (i % 4)}) for i in range(60)]
    df = frame(spark, "id int, name string, type string, properties map<string,string>", *data)
    index = monitor.index_components(df)
    want = {(t[k : k + 3], i) for i, *cols, p in data if i is not None for t in map(str.lower, [*cols, *p.values()]) for k in range(max(1, len(t) - 2))}
    got = [(r.gram, r.id) for r in index.collect()]
    assert len(got) == len(want) and set(got) == want
    assert len(index.inputFiles()) > 4
    for text in ("abab", "e 2", "vv"):
        assert rows(monitor.search_components_indexed(df.where("id IS NOT NULL"), index, text), "id") == rows(monitor.search_components(df.where("id IS NOT NULL"), text), "id")


def test_indexed_search_equals_the_scan(spark):
    data = [(1, "Fetch FILES", "Get", {"path": "/in/Ünï"}), (2, "", "Put", {"a": "xy", "b": None}), (3, None, "x", None), (4, "fe", "tch f", {}), (5, "ab abab", "ABAB", {"k": "100%_a"})]
    df = frame(spark, "id int, name string, type string, properties map<string,string>", *data)
    index = monitor.index_components(df)
    for text in ("f", "fe", "tch", "fetch f", "ÜNÏ", "xy", "x", "abab", "babab", "%_", "nothing", "/"):
        assert rows(monitor.search_components_indexed(df, index, text), "id") == rows(monitor.search_components(df, text), "id")
    with pytest.raises(ValueError, match="query"):
        monitor.search_components_indexed(df, index, " ")


def test_wait_with_a_time_out_in_batch(spark):
    """Against every pair, with a busy key, equal times and null keys."""
    rng = random.Random(1)
    at = lambda: f"2024-01-01 {rng.randint(0, 5):02d}:{rng.choice(['00', '30'])}:00"
    waits = [(i, rng.choice("aaab") if i % 20 else None, at()) for i in range(200)] + [(900, "a", None), (901, "z", at())] + [(902, "b", "2024-01-01 01:00:00")] * 2
    signals = [(rng.choice("aaab") if i % 20 else None, at(), rng.choice([None, 0, 1, 2])) for i in range(150)]
    found = routing.label_wait_notify_timeout(
        frame(spark, "id int, k string, ts string", *waits), frame(spark, "k string, ts string, n int", *signals), "k", 9, 3600, count_col="n"
    )
    hours = lambda t: int(t[11:13]) + int(t[14:16]) / 60
    wanted = []
    for i, k, t in waits:
        n = sum(v or 0 for key, s, v in signals if k is not None and t and key == k and abs(hours(s) - hours(t)) <= 1)
        wanted.append((i, n, "released" if n >= 9 else "expired"))
    assert rows(found, "id", "signals", "outcome") == sorted(wanted, key=repr)


def test_search_looks_into_properties(spark):
    df = frame(
        spark, "id int, name string, properties map<string,string>, group_id string",
        (1, "a", {"k": "has Needle"}, "g"), (2, "NEEDLE", None, "h"), (3, "c", {"needle": "x"}, "g"),
    )
    assert rows(monitor.search_components(df, "needle"), "id") == [(1,), (2,)]
    assert rows(monitor.search_components(df, "needle", group_id="g"), "id") == [(1,)]


def test_search_keeps_its_filters_at_the_scan(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "ts", F.col("event_type").alias("component_type")
    )
    found = monitor.provenance_search(events, component_type="error", start="2024-01-05")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan and "GreaterThanOrEqual(ts," in plan
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_null_threshold_is_no_limit(spark):
    queue = frame(spark, "connection_id string, size_bytes bigint, ts date", ("a", 1024, None), ("a", 0, None))
    links = frame(
        spark, "connection_id string, object_threshold bigint, size_threshold string",
        ("a", 2, None), ("b", None, "0 B"), ("c", None, None),
    )
    found = monitor.back_pressure(queue, links)
    assert rows(found, "connection_id", "over_count", "over_bytes", "under_pressure") == [
        ("a", True, False, True), ("b", False, True, True), ("c", False, False, False),
    ]


# Routing and records

def test_null_predicates_do_not_match_and_first_partitions_the_input(spark):
    df = frame(spark, "id int, x int", (1, 5), (2, None), (3, 50), (4, 500))
    predicates = {"big": "x > 10", "huge": "x > 100", "odd": "x % 2 = 1"}
    every = routing.route_on_attribute(df, predicates)
    assert {k: [r.id for r in v.collect()] for k, v in every.items()} == {
        "big": [3, 4], "huge": [4], "odd": [1], "unmatched": [2],
    }
    first = routing.route_on_attribute(df, predicates, "first")
    ids = [r.id for v in first.values() for r in v.collect()]
    assert sorted(ids) == [1, 2, 3, 4]
    assert [r.id for r in first["huge"].collect()] == []


def test_labels_are_the_routes_in_one_pass(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "value", "event_type")
    predicates = {"big": "value > 50", "huge": "value > 90", "views": "event_type = 'view'"}
    for mode in ("all", "first"):
        labelled = routing.label_on_attribute(events, predicates, mode, "route")
        for name, routed in routing.route_on_attribute(events, predicates, mode).items():
            assert labelled.where(F.col("route") == name).count() == routed.count()
        plan = labelled._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    parsed = routing.label_outcome(events, "value > 10", F.lit("small"))
    assert {(r.relationship, r.reason) for r in parsed.select("relationship", "reason").distinct().collect()} == {
        ("success", None), ("failure", "small"),
    }


def test_wait_counts_amounts(spark):
    waiting = frame(spark, "k string, id int", ("a", 1), ("b", 2), ("a", 3), (None, 4))
    signals = frame(spark, "k string, n int", ("a", 2), ("a", 3), ("b", 4))
    out = routing.wait_notify(waiting, signals, "k", 5, "n")
    assert rows(out["released"], "id", "signals") == [(1, 5), (3, 5)]
    assert rows(out["waiting"], "id", "signals") == [(2, 4), (4, 0)]


@pytest.mark.parametrize("fmt, good, bad", [
    ("json", '{"a":1,"b":"x"}', '{"a":"no"}'), ("csv", "1,x", "no,x"),
    ("xml", "<r><a>1</a><b>x</b></r>", "<r><a>no</a></r>"),
])
def test_records_that_do_not_fit_go_to_failure(spark, fmt, good, bad):
    df = frame(spark, "id int, text string", (1, good), (2, bad), (3, None))
    routes = records.convert_records(df, "text", fmt, "json", "a int, b string")
    assert rows(routes["success"]) == [(1, '{"a":1,"b":"x"}')]
    assert rows(routes["failure"], "id", "text") == [(2, bad), (3, None)]
    assert all(r.reason for r in routes["failure"].collect())


def test_xml_and_csv_can_be_written(spark):
    df = frame(spark, "text string", ('{"a":1,"b":"x"}',))
    to_csv = records.convert_records(df, "text", "json", "csv", "a int, b string")["success"]
    to_xml = records.convert_records(df, "text", "json", "xml", "a int, b string")["success"]
    assert to_csv.first().text == "1,x"
    assert "<a>1</a>" in to_xml.first().text and "<b>x</b>" in to_xml.first().text


def test_json_steps(spark):
    df = frame(spark, "text string", ('{"a":{"b":1},"c":"x","d":null}',), ("{}",), ("broken",), (None,), ("[1]",))
    steps = [
        {"op": "shift", "fields": {"a.b:int": "n.v", "c": "s", "no": "gone.x"}},
        {"op": "default", "fields": {"s": "none", "k": True}},
        {"op": "remove", "fields": ["gone"]},
    ]
    routes = records.restructure_json(df, "text", steps)
    assert sorted(map(repr, (r.text for r in routes["failure"].collect()))) == ["'[1]'", "'broken'", "None"]
    assert [r.text for r in routes["success"].collect()] == [
        '{"n":{"v":1},"s":"x","k":true}', '{"n":{},"s":"none","k":true}',
    ]
    with pytest.raises(ValueError, match="unknown step"):
        records.restructure_json(df, "text", [{"op": "spin", "fields": {}}])
    with pytest.raises(ValueError, match="no steps"):
        records.restructure_json(df, "text", [])


def test_element_fields(spark):
    df = spark.range(1).select(
        F.expr("array(named_struct('n', 1, 'm', 2), named_struct('n', 3, 'm', 4))").alias("items")
    )
    by_text = records.update_record(df, {"items[].n": "item.n + item.m", "items[].new": "'x'"})
    assert [tuple(i) for i in by_text.first()["items"]] == [(3, 2, "x"), (7, 4, "x")]
    by_column = records.update_record(df, {"items[].n": F.lit(0), "items[].m": None})
    assert [tuple(i) for i in by_column.first()["items"]] == [(0,), (0,)]


def test_sql_over_named_frames(spark):
    a = frame(spark, "k int, x string", (1, "a"), (2, "b"))
    found = records.query_record(
        {"left": a, "right": a.limit(1)},
        "SELECT l.x FROM {left} l LEFT ANTI JOIN {right} r ON l.k = r.k WHERE l.k < :most",
        {"most": 10},
    )
    assert rows(found) == [("b",)]
