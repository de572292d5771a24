"""Conversation repair against a shortest path over every edit, and on odd input."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from millrace.llm import QUERIES, conversation_repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
# What may follow: state -> {initial: state}; 0 nothing, 1 system, 2 user, 3 assistant.
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired rows): the least of all edit sequences, by cost and then by letters."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            # A cheaper end cannot come later; equal ones come in the order of letters.
            return cost, audit, list(kept)
        for initial, to in MOVES[state].items():
            if initial in NAMES:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*kept, f"{NAMES[initial]}:")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, kept))
        if fault in ("blank", "duplicate"):
            continue
        extra = 5 if fault == "truncated" else 0
        for initial, to in MOVES[state].items():
            if initial == role[:1]:
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to, (*kept, f"{role}:{text}")))
            if initial in NAMES:
                heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, to, (*kept, f"{NAMES[initial]}:{text}")))


def by_hand(rows):
    """conv_id -> the result of the contract, one conversation at a time."""
    space = lambda x: " " if x is None else str(x)
    kept = {}
    for conv, turn, role, text in rows:
        own = kept.setdefault(conv, [])
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else space(role), "" if kind == 1 else space(text)
        text = re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * (kind != 0) * (1 + (kind == 3))
    out = {}
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, faults, marked = set(), [], []
        for _, role, text in own:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            marked.append((role, text, fault))
        turns = {t for t, _, _ in own if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, left = cheapest(marked)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


def same(result, rows):
    found = {r[0]: tuple(r[1:]) for r in result.select(*COLUMNS).collect()}
    wanted = by_hand(rows)
    assert found.keys() == wanted.keys()
    assert not {c: (found[c], wanted[c]) for c in wanted if found[c] != wanted[c]}


def made(chance, conversations, longest):
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "Why?", "It is. ", "more. . ", "é ß.", "a\nb."]
    for conv in range(conversations):
        for turn in range(chance.randint(1, longest)):
            role = chance.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            turn = None if chance.random() < 0.05 else turn + chance.choice([0, 0, 0, 3, -1])
            yield conv, turn, role, chance.choice([*texts, *texts, None])


SCHEMA = "conv_id long, turn long, role string, text string"


def test_block_tables_are_the_shortest_path():
    chance, t = random.Random(1), conversation_repair.tables()
    for _ in range(500):
        rows = [(chance.choice(["s", "u", "a", ""]), "", chance.choice([None, None, "truncated", "blank"])) for _ in range(chance.randint(0, 11))]
        symbols = [1 if f == "blank" else conversation_repair.SYMBOLS[r, int(f == "truncated")] for r, _, f in rows]
        symbols = conversation_repair.np.array(symbols, "uint8")
        found, paid = t.ends(0, conversation_repair.coded(symbols)[1])
        audit, state = t.trace(symbols, 0, 0)
        assert (paid + t.vectors[found[-1]][0], audit + t.last[state]) == cheapest(rows)[:2]


def test_every_conversation_by_hand(spark):
    rows = list(made(random.Random(2), 250, 14))
    same(conversation_repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(4)), rows)


def test_conversations_over_many_segments(spark, monkeypatch):
    """Rows of one conversation in many tasks, many segments of a task, one row repeated over and over."""
    chance = random.Random(3)
    rows = list(made(chance, 3, 400)) + [(7, turn, role, f"Turn {turn}.") for turn in range(300) for role in ("user", "assistant")]
    rows += [(8, 5, "user", "The same.")] * 300 + [(8, 6, "assistant", "Other.")] + [(9, None, "user", f"{i}.") for i in range(120)]
    chance.shuffle(rows)
    # The limits are read where the function is pickled, so they hold in the workers.
    cut = conversation_repair._cut

    def small(batches):
        conversation_repair.SEGMENT_ROWS, conversation_repair.SEGMENT_CHARS = 16, 300
        return cut(batches)

    monkeypatch.setattr(conversation_repair, "_cut", small)
    same(conversation_repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(6)), rows)


def test_odd_conversations(spark):
    big = 2**62 + 1
    rows = [
        (None, 1, "user", "No id."), (None, 2, "assistant", "No id."), (1, None, None, None), (2, 1, "", "x."), (3, big, "user", "Far."), (3, 0, "assistant", "Near."),
        (4, 1, "system", "only."), (5, -5, "user", "a." * 300_000), (5, -4, "assistant", "b"), (6, 3, "ünknown", "ü\x00."), (big, None, "user", "z."),
    ]
    rows += [(conv, turn, "user", "t") for conv in range(10, 60) for turn in range(1)]
    plain = spark.createDataFrame(rows, SCHEMA)
    same(conversation_repair.repair(plain), rows)
    clash = plain.selectExpr("*", "1 AS c", "2 AS k", "3 AS part", "'x' AS digest", "4 AS salt", "true AS gone", "5 AS kind", "6 AS cost")
    same(conversation_repair.repair(clash), rows)
    assert conversation_repair.repair(plain.where("false")).count() == 0


def test_registered_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op11_conversation_repair"](spark, folder), rows)


@pytest.mark.parametrize("rows, audit", [([], ""), ([("user", "Hi.", None)], "D"), ([("user", "Hi.", None), ("assistant", "Ho.", None)], "KK")])
def test_hand_made_repairs(rows, audit):
    assert cheapest(rows)[1] == audit
