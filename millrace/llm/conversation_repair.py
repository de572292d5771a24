"""Cheapest repair of conversations by Four-Russians block tables.

A repaired conversation is empty or an optional system turn and then pairs of user and
assistant, which an automaton of four states reads. A row is one of nine symbols (its
role, whether it is cut off, or that it has to go). Costs to finish from the four states
form a vector; taking out its minimum leaves a handful of vectors, so the step over any
block of ``BLOCK`` symbols is a table from (block, vector) to (vector, cost), made once.

1. Rows are sorted over all tasks by conversation and turn, so a conversation of any
   length lies in consecutive tasks. A task cuts it into segments of bounded size.
2. From its end a segment is gone through block by block in the table. Then each block is
   expanded backward to the vectors between its rows, and the edits are read off forward:
   in every state the ASCII-least edit that loses nothing, so ties are settled exactly.
3. Conversations that lie in one segment end there. The few that reach over the border of
   a segment go on by segment: repeats by a join of digests, costs by a 4 x 4 matrix for
   each segment, which are strung together, one small row for each segment, in one pass
   from the end (vectors) and one from the front (states).
4. Only the hash of a repaired text is one sequence by its nature: the pieces of a
   conversation are streamed in order through one task, a segment at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup_join
from millrace.session import configure

from .frames import prepare, stored

BLOCK = 4
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 4_000_000

DELETE, RELABEL, INSERT, CUT_OFF = 2, 1, 5, 5
# States: nothing yet, after system, after user, after assistant.
STATES = 4
TARGET = (2, 2, 3, 2)
ROLE_TO = {2: "user", 3: "assistant"}
# The state that a kept role leads to from each state.
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "": {}}
NEVER = 1 << 40
# Symbols: no row, a row that has to go, then each role whole and cut off.
NONE, GONE = 0, 1
SYMBOLS = {(role, cut): 2 + 2 * i + cut for i, role in enumerate(KEPT) for cut in (0, 1)}
N_SYMBOLS = 2 + len(SYMBOLS)
FINAL = (0, 10, 5, 0)
LEGAL = {"su", "ua", "au"}
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _closed(costs: list[int]) -> tuple[int, ...]:
    """With inserted turns wherever they are cheaper."""
    for _ in range(STATES):
        costs = [min(c, INSERT + costs[TARGET[s]]) for s, c in enumerate(costs)]
    return tuple(min(c, NEVER) for c in costs)


def _choices(symbol: int, after: tuple[int, ...], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost to finish, next state) of what may be done with the row, without insertions."""
    if symbol == GONE:
        return [("D", DELETE + after[state], state)]
    role, cut = next(key for key, at in SYMBOLS.items() if at == symbol)
    extra = CUT_OFF * cut
    out = [("D", DELETE + after[state], state), ("R", RELABEL + extra + after[TARGET[state]], TARGET[state])]
    if state in KEPT[role]:
        out.append(("K", extra + after[KEPT[role][state]], KEPT[role][state]))
    return out


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector in front of a row from the one behind it."""
    if symbol == NONE:
        return after
    return _closed([min(c for _, c, _ in _choices(symbol, after, s)) for s in range(STATES)])


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(vector)
    return tuple(c if c >= NEVER else c - low for c in vector), low


class Tables:
    """All vectors that occur, and the steps over one row and over a block."""

    def __init__(self) -> None:
        # Where a segment may end: the end of all, or in one certain state.
        ends = [FINAL, *[_closed([0 if s == t else NEVER for s in range(STATES)]) for t in range(STATES)]]
        self.vectors = [_normal(v)[0] for v in ends]
        self.number = {v: i for i, v in enumerate(self.vectors)}
        step, cost = [], []
        for vector in self.vectors:  # grows until no step leads to a new one
            to = [_normal(_before(symbol, vector)) for symbol in range(N_SYMBOLS)]
            for found, _ in to:
                if found not in self.number:
                    self.number[found] = len(self.vectors)
                    self.vectors.append(found)
            step.append([self.number[found] for found, _ in to])
            cost.append([low for _, low in to])
        one, paid = np.array(step).T, np.array(cost).T
        block, total = one, paid
        for _ in range(BLOCK - 1):  # one symbol more in front
            block, total = np.concatenate(list(one[:, block])), np.concatenate(list(total + paid[:, block]))
        self.row = one.tolist()
        self.block, self.cost = block.tolist(), total.tolist()
        self.edit = [[[self._edit(symbol, v, s) for s in range(STATES)] for v in self.vectors] for symbol in range(N_SYMBOLS)]
        self.last = ["", "II", "I", ""]

    def _edit(self, symbol: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
        """The letters up to and with the row's own, and the state behind it."""
        before, letters = _before(symbol, after), ""
        if symbol == NONE or before[state] >= NEVER:
            return "", state
        while True:
            ways = [("I", INSERT + before[TARGET[state]], TARGET[state]), *_choices(symbol, after, state)]
            letter, _, state = min(way for way in ways if way[1] == before[state])
            letters += letter
            if letter != "I":
                return letters, state

    def ends(self, vector: int, codes: list[int]) -> tuple[list[int], int]:
        """The vectors behind each block, the last first, then the one in front of all; the cost taken out."""
        found, paid = [vector], 0
        for code in reversed(codes):
            paid += self.cost[code][vector]
            vector = self.block[code][vector]
            found.append(vector)
        return found, paid

    def trace(self, symbols: np.ndarray, vector: int, state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits from ``state`` on, and the state behind them."""
        padded, codes = coded(symbols)
        behind = self.ends(vector, codes)[0][-2::-1]
        letters = []
        for at, after in zip(range(0, len(padded), BLOCK), behind, strict=True):
            block = padded[at : at + BLOCK]
            inner = [after]
            for symbol in block[:0:-1]:
                inner.append(self.row[symbol][inner[-1]])
            for symbol, v in zip(block, reversed(inner), strict=True):
                edit, state = self.edit[symbol][v][state]
                letters.append(edit)
        return "".join(letters), state


@cache
def tables() -> Tables:
    return Tables()


def coded(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """The symbols filled up in front to whole blocks, and the number of each block."""
    padded = np.concatenate([np.full(-len(symbols) % BLOCK, NONE), symbols]).astype(int)
    return padded.tolist(), (padded.reshape(-1, BLOCK) @ N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()


def faults(roles: list[str], texts: list[str], repeated: set[int]) -> tuple[np.ndarray, list[int]]:
    """The symbol of each row, and the numbers of blank, repeated and cut-off rows."""
    symbols, counts = np.zeros(len(roles), np.uint8), [0, 0, 0]
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        bare = text.rstrip(SPACES)
        kind = 0 if not bare else 1 if i in repeated else 2 if bare[-1] not in ".!?" else None
        if kind is not None:
            counts[kind] += 1
        role = role[:1] if role[:1] in KEPT else ""
        symbols[i] = GONE if kind in (0, 1) else SYMBOLS[role, int(kind == 2)]
    return symbols, counts


def repeats(digests: list[bytes], texts: list[str]) -> tuple[set[int], list[int]]:
    """Rows that repeat an earlier one, and the first of each that is not blank."""
    seen, later, first = set(), set(), []
    for i, (digest, text) in enumerate(zip(digests, texts, strict=True)):
        if text.strip(SPACES):
            if digest in seen:
                later.add(i)
            else:
                seen.add(digest)
                first.append(i)
    return later, first


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The rows that the edits leave, as role:text."""
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            state = KEPT[roles[i][:1]][state]
        else:
            state = TARGET[state]
        if letter == "I":
            out.append(f"{ROLE_TO[state]}:")
            continue
        out.append(f"{roles[i] if letter == 'K' else ROLE_TO[state]}:{texts[i]}")
        i += 1
    return out


def distinct_turns(turns: list[str]) -> tuple[int | None, int | None, int]:
    """First, last and number of the distinct turns, which rise; nulls (empty) do not count."""
    known = [int(t) for t in turns if t]
    return (known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:], strict=False))) if known else (None, None, 0)


def illegal_pairs(roles: list[str]) -> int:
    """Neighbours whose initials no conversation may have."""
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of the contract after damage; dropped rows stay as ``gone``, so that no conversation is lost."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", kind.alias("kind"))
        .withColumn("copy", F.explode(copies))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(space("role")).alias("role"),
            F.when(F.col("kind") != 0, text).otherwise("").alias("text"),
            (F.col("kind") == 0).alias("gone"),
        )
        .withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    )


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SEGMENT = (
    "part int, k int, first long, last long, distinct long, pairs long, head string, tail string, n long, "
    "roles array<string>, texts array<string>, firsts array<struct<digest: string, at: int>>, later array<int>"
)
PLACE = ["c", "part", "k"]


def _names(schema: str) -> list[str]:
    return re.findall(r"(\w+) (?:long|int|string|array|binary|boolean)", re.sub(r"struct<.*?>", "", schema))


class _Rows:
    """Consecutive rows of one conversation without the dropped ones; n and chars count all."""

    def __init__(self) -> None:
        self.turns, self.roles, self.texts, self.digests, self.n, self.chars = [], [], [], [], 0, 0

    def add(self, turn: str, role: str, text: str, digest: str, gone: bool) -> None:
        self.n, self.chars = self.n + 1, self.chars + len(text)
        if not gone:
            self.turns.append(turn)
            self.roles.append(role)
            self.texts.append(text)
            self.digests.append(digest)

    def whole(self, c: str) -> tuple:
        """The result of a conversation that lies in one segment."""
        symbols, counts = faults(self.roles, self.texts, repeats(self.digests, self.texts)[0])
        first, last, distinct = distinct_turns(self.turns)
        t = tables()
        found, paid = t.ends(0, coded(symbols)[1])
        audit, state = t.trace(symbols, 0, 0)
        audit += t.last[state]
        text = "\n".join(repaired(audit, 0, self.roles, self.texts)).encode("utf-8", "surrogatepass")
        gaps = last - first + 1 - distinct if distinct else 0
        facts = [gaps, *counts, illegal_pairs(self.roles), paid + t.vectors[found[-1]][0], audit, hashlib.sha256(text).hexdigest()]
        return (c, *facts, *[None] * len(_names(SEGMENT)))

    def segment(self, c: str, k: int) -> tuple:
        later, first = repeats(self.digests, self.texts)
        ends = [self.roles[0][:1], self.roles[-1][:1]] if self.roles else [None, None]
        facts = [*distinct_turns(self.turns), illegal_pairs(self.roles), *ends, len(self.roles)]
        firsts = [{"digest": self.digests[i], "at": i} for i in first]
        place = (TaskContext.get().partitionId(), k)
        return (c, *[None] * len(_names(RESULT)), *place, *facts, self.roles, self.texts, firsts, sorted(later))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of the conversations that lie within this task, and segments of the others.

    The first and the last of a task may go on in its neighbours, so they are never taken as whole.
    """
    columns = ["c", *_names(RESULT), *_names(SEGMENT)]
    held, k, whole, conv = _Rows(), 0, False, None
    for frame in batches:
        out = []
        for c, *row in zip(*[frame[x].tolist() for x in ("c", "turn", "role", "text", "digest", "gone")], strict=True):
            if c != conv:
                if held.n:
                    out.append(held.whole(conv) if whole else held.segment(conv, k))
                held, k, whole, conv = _Rows(), 0, conv is not None, c
            if held.n and (held.n == SEGMENT_ROWS or held.chars + len(row[2]) > SEGMENT_CHARS):
                out.append(held.segment(conv, k))
                held, k, whole = _Rows(), k + 1, False
            held.add(*row)
        yield pd.DataFrame(out, columns=columns, dtype=object)
    if held.n:
        yield pd.DataFrame([held.segment(conv, k)], columns=columns, dtype=object)


FACTS = "c string, part int, k int, symbols binary, blank long, duplicate long, truncated long, matrix array<long>"


def _facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Symbols, faults, and for each state in front of a segment the costs to reach each state behind it."""
    t = tables()
    basis = [t.number[_closed([0 if s == end else NEVER for s in range(STATES)])] for end in range(STATES)]
    for batch in batches:
        rows = []
        for s in batch.itertuples():
            symbols, counts = faults(list(s.roles), list(s.texts), {*s.later, *s.elsewhere})
            codes, matrix = coded(symbols)[1], []
            for end in basis:
                found, paid = t.ends(end, codes)
                matrix.append([min(paid + c, NEVER) for c in t.vectors[found[-1]]])
            rows.append((s.c, s.part, s.k, symbols.tobytes(), *counts, sum(matrix, [])))
        yield pd.DataFrame(rows, columns=_names(FACTS))


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The vector behind each segment, from the last to the first, and the cost in front of it."""
    t, conv = tables(), None
    for batch in batches:
        out = []
        for s in batch.itertuples():
            if s.c != conv:
                conv, vector = s.c, FINAL
            behind = t.number[_normal(vector)[0]]
            costs = (np.array(s.matrix).reshape(STATES, STATES) + np.array(vector)[:, None]).min(axis=0)
            vector = tuple(int(min(x, NEVER)) for x in costs)
            out.append((s.c, s.part, s.k, behind, vector[0]))
        yield pd.DataFrame(out, columns=[*PLACE, "vector", "cost"])


def _maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of each segment, and the state behind it, for each state in front of it."""
    t = tables()
    for batch in batches:
        found = [[t.trace(np.frombuffer(s, np.uint8), int(v), x) for x in range(STATES)] for s, v in zip(batch["symbols"], batch["vector"], strict=True)]
        yield batch[PLACE].assign(audits=[[a for a, _ in f] for f in found], states=[[x for _, x in f] for f in found])


def _string(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The states in front of and behind each segment, and what its border adds, from the first to the last."""
    conv = None
    for batch in batches:
        out = []
        for s in batch.itertuples():
            if s.c != conv:
                conv, state, tail, last = s.c, 0, None, None
            illegal = int(bool(s.n) and tail is not None and tail + (s.head or "") not in LEGAL)
            same = int(bool(s.distinct) and last is not None and last == s.first)
            tail, last = s.tail if s.n else tail, s.last if s.distinct else last
            before, state = state, int(s.states[state])
            out.append((s.c, s.part, s.k, before, state, illegal, same))
        yield pd.DataFrame(out, columns=[*PLACE, "before", "behind", "illegal", "same"])


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        left = [repaired(s.audit, int(s.before), list(s.roles), list(s.texts)) for s in batch.itertuples()]
        yield batch[[*PLACE, "behind", "audit"]].assign(text=["\n".join(x) for x in left], some=[bool(x) for x in left])


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and hash of each conversation from its pieces in order."""
    t, conv = tables(), None

    def done() -> pd.DataFrame:
        end, state = t.last[behind], behind
        for _ in end:
            state = TARGET[state]
            add(f"{ROLE_TO[state]}:")
        return pd.DataFrame([(conv, "".join(audit) + end, digest.hexdigest())], columns=["c", "audit", "repaired_sha256"])

    def add(text: str) -> None:
        nonlocal some
        digest.update((b"\n" if some else b"") + text.encode("utf-8", "surrogatepass"))
        some = True

    for batch in batches:
        for s in batch.itertuples():
            if s.c != conv:
                if conv is not None:
                    yield done()
                conv, audit, digest, some = s.c, [], hashlib.sha256(), False
            audit.append(s.audit)
            behind = s.behind
            if s.some:
                add(s.text)
    if conv is not None:
        yield done()


def _in_order(df: DataFrame, falling: bool = False) -> DataFrame:
    """The segments of a conversation in one task, which streams them."""
    order = [F.desc(x) if falling else F.asc(x) for x in ("part", "k")]
    return df.repartition("c").sortWithinPartitions("c", *order)


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conv_id.

    The damage and the counts are those of the contract. Rows with a null conv_id are one
    conversation; null turns come first; a null role or text is one space. Rows of one
    conversation and turn are ordered by role, then by a digest of role and text; equal rows
    cannot be told apart. A role counts by its first letter, an empty one has none and is
    never kept. An empty table gives no row; other columns are ignored. A task holds at most
    SEGMENT_ROWS rows of about SEGMENT_CHARS characters together, one row at least.
    """
    prepare(configure(conversations.sparkSession))
    key = ["conv_id", "turn", "role", "digest", "salt"]
    # Equal rows are dealt by their number, so no row is too frequent for one task.
    rows = damage(conversations).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    sorted_rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    light = sorted_rows.select(text("conv_id").alias("c"), text("turn"), "role", "text", "digest", "gone")
    found = stored(light.mapInPandas(_cut, f"c string, {RESULT}, {SEGMENT}"), "conversations")
    done, segments = found.where("part is null").select("c", *_names(RESULT)), found.where("part is not null")

    first = segments.select(*PLACE, F.explode("firsts").alias("f")).select(*PLACE, "f.digest", "f.at")
    earliest = first.groupBy("c", "digest").agg(F.min(F.struct("part", "k")).alias("where"), F.count("*").alias("times")).where("times > 1")
    again = lookup_join(first, earliest, ["c", "digest"], "inner").where(F.struct("part", "k") > F.col("where"))
    elsewhere = again.groupBy(*PLACE).agg(F.collect_list("at").alias("elsewhere"))
    whole = segments.join(elsewhere, PLACE, "left").withColumn("elsewhere", F.coalesce("elsewhere", F.array().cast("array<int>")))
    facts = stored(whole.select(*PLACE, "roles", "texts", "later", "elsewhere").mapInPandas(_facts, FACTS), "facts")

    vectors = _in_order(facts.select(*PLACE, "matrix"), falling=True).mapInPandas(_vectors, "c string, part int, k int, vector int, cost long")
    vectors = stored(vectors, "vectors")
    maps = facts.select(*PLACE, "symbols").join(vectors, PLACE).select(*PLACE, "symbols", "vector")
    maps = stored(maps.mapInPandas(_maps, "c string, part int, k int, audits array<string>, states array<int>"), "maps")
    borders = segments.select(*PLACE, text("first"), text("last"), "distinct", "head", "tail", "n").join(maps.drop("audits"), PLACE)
    strung = _in_order(borders).mapInPandas(_string, "c string, part int, k int, before int, behind int, illegal long, same long")
    strung = stored(strung, "states")

    edits = maps.join(strung, PLACE).select(*PLACE, "before", "behind", F.col("audits")[F.col("before")].alias("audit"))
    pieces = segments.select(*PLACE, "roles", "texts").join(edits, PLACE)
    pieces = pieces.mapInPandas(_pieces, "c string, part int, k int, behind int, audit string, text string, some boolean")
    hashed = _in_order(pieces).mapInPandas(_hash, "c string, audit string, repaired_sha256 string")
    gaps = F.max("last") - F.min("first") + 1 - F.sum(F.col("distinct") - F.col("same"))
    counts = (
        segments.select(*PLACE, "first", "last", "distinct", "pairs")
        .join(facts.select(*PLACE, "blank", "duplicate", "truncated"), PLACE)
        .join(strung.select(*PLACE, "illegal", "same"), PLACE)
        .join(vectors.select(*PLACE, "cost"), PLACE)
        .groupBy("c")
        .agg(
            F.coalesce(gaps, F.lit(0)).alias("gaps"),
            *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")],
            F.sum(F.col("pairs") + F.col("illegal")).alias("illegal"),
            F.min_by("cost", F.struct("part", "k")).alias("cost"),
        )
    )
    both = done.union(counts.join(hashed, "c").select("c", *_names(RESULT)))
    return both.select(F.when(F.col("c") != "", F.col("c").cast("long")).alias("conv_id"), *_names(RESULT))
