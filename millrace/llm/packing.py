"""Documents packed into sequences by a grouping genetic algorithm on islands.

Texts become token ids where they are read; only the places of their pieces move on.
Pieces are dealt to shards of about SHARD_PIECES, whatever the input. A solution is a
list of bins. Crossover puts some of one parent's best-filled bins into the other, drops
the bins that now hold a piece twice, and best-fits the displaced pieces, largest first.
Each shard is bred on ISLANDS islands; after each of EPOCHS epochs the best solution of
an island also goes to the next one. An island stops where the total length shows that no
solution has fewer bins. The badly filled bins of all shards are packed once more together,
level by level, until one shard is left, so shards cost no sequences.
"""

from __future__ import annotations

import base64
import random
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import prepare, stored

LENGTH = 2048
END = 0
SHARD_PIECES = 4000
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
# Bins with less are packed again together with those of other shards.
WELL_FILLED = 0.99
LEVELS = 12

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _encoders(tokenizer: str, ranks: str | None):
    """The tokenizer, and a faster encoder of the same vocabulary if its ranks are at hand."""
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(tokenizer), None
    if ranks:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return slow, fast


def token_ids(text: str | None, tokenizer: str, ranks: str | None = None) -> np.ndarray:
    """The ids of one document, with END behind; texts that may hold a special token go to the tokenizer itself."""
    slow, fast = _encoders(tokenizer, ranks)
    text = text if isinstance(text, str) else ""
    ids = slow.encode(text, add_special_tokens=False).ids if fast is None or "<|" in text else fast.encode_ordinary(text)
    return np.array([*ids, END], "<u4")


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a document that is too long is cut, its first piece may be shorter."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = token_ids(text, tokenizer, ranks)
                first = len(ids) % length or length
                bounds = [0, *range(first, len(ids) + 1, length)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, PIECES)


class _Bins:
    """Open bins by what is left in them."""

    def __init__(self, length: int):
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self.some = 0  # bit r: a bin with room r
        self.length = length

    def put(self, number: int, room: int) -> None:
        self.by_room[room].append(number)
        self.some |= 1 << room

    def best_fit(self, size: int) -> tuple[int, int] | None:
        """The bin with the least room that is enough, taken out, and its room."""
        fits = self.some >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        number = self.by_room[room].pop()
        if not self.by_room[room]:
            self.some &= ~(1 << room)
        return number, room


def best_fit(sizes: np.ndarray, bins: np.ndarray, length: int) -> np.ndarray:
    """Put the pieces with bin -1 into the bins, in the order given; new bins where none fits."""
    todo = np.flatnonzero(bins < 0)
    used = bins >= 0
    number = np.full(len(bins), -1)
    names, number[used] = np.unique(bins[used], return_inverse=True)
    n = len(names)
    rooms = _Bins(length)
    for k, room in enumerate((length - np.bincount(number[used], sizes[used], n)).astype(int).tolist()):
        rooms.put(k, room)
    size_of = sizes.tolist()
    for i in todo.tolist():
        found = rooms.best_fit(size_of[i])
        if found is None:
            found, n = (n, length), n + 1
        number[i] = found[0]
        rooms.put(found[0], found[1] - size_of[i])
    return number


def _fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes)


def fitness(sizes: np.ndarray, bins: np.ndarray, length: int) -> tuple[int, float]:
    """Fewer bins first, then more uneven ones: (bins, minus the mean square of their filling)."""
    fills = _fills(sizes, bins)
    return len(fills), -float(np.mean((fills / length) ** 2)) if len(fills) else 0.0


def crossover(sizes: np.ndarray, one: np.ndarray, two: np.ndarray, length: int, chance: random.Random) -> np.ndarray:
    """Some of the best-filled bins of ``two`` in ``one``; what they displace is best-fitted."""
    fills = _fills(sizes, two)
    best = np.argsort(-fills, kind="stable")[: max(1, len(fills) // 2)].tolist()
    taken = np.zeros(len(fills), bool)
    taken[chance.sample(best, max(1, len(best) // 2))] = True
    inside = taken[two]
    broken = np.zeros(one.max() + 1, bool)
    broken[one[inside]] = True
    child = np.where(broken[one], -1, one)
    child[inside] = two[inside] + len(broken)
    return best_fit(sizes, child, length)


def mutated(sizes: np.ndarray, bins: np.ndarray, length: int, chance: random.Random) -> np.ndarray:
    """Empty a few bins, badly filled ones rather than others, and best-fit their pieces."""
    fills = _fills(sizes, bins)
    worst = np.argsort(fills, kind="stable")[: max(2, len(fills) // 20)].tolist()
    out = np.zeros(len(fills), bool)
    out[chance.sample(worst, min(len(worst), 3)) + chance.sample(range(len(fills)), min(len(fills), 3))] = True
    return best_fit(sizes, np.where(out[bins], -1, bins), length)


def evolve(sizes: np.ndarray, known: list[np.ndarray], length: int, seed: int) -> list[np.ndarray]:
    """The two best solutions after GENERATIONS; ``sizes`` fall. One is enough if it is perfect."""
    chance = random.Random(seed)
    least = -(-int(sizes.sum()) // length)
    people = [*known, best_fit(sizes, np.full(len(sizes), -1), length)]
    rank = lambda b: fitness(sizes, b, length)
    people.sort(key=rank)
    if rank(people[0])[0] <= least:
        return people[:1]
    while len(people) < POPULATION:
        people.append(mutated(sizes, people[0], length, chance))
    for _ in range(GENERATIONS):
        one, two = chance.sample(people, 2)
        people += [crossover(sizes, one, two, length, chance), mutated(sizes, people[0], length, chance)]
        people = sorted(people, key=rank)[:POPULATION]
        if rank(people[0])[0] <= least:
            return people[:1]
    return people[:2]


_ORDER = ["length", "doc_id", "piece", "start", "ids_crc32"]


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of a shard in the order that solutions number them."""
    return rows.sort_values(_ORDER, ascending=[False, True, True, True, True], ignore_index=True)


def _bred(rows: DataFrame, length: int) -> DataFrame:
    """(shard, bins): the best solution of each shard of rows (shard and the piece's columns)."""
    state = None
    schema = "shard long, island int, rank int, n_bins int, bins array<int>"
    homes = rows.select("shard", *_ORDER).withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    for epoch in range(EPOCHS):

        def bred(key: tuple, shard: pd.DataFrame, elite: pd.DataFrame, epoch: int = epoch) -> pd.DataFrame:
            sizes = _shard(shard)["length"].to_numpy()
            known = [np.array(b) for b in elite.sort_values(["n_bins", "rank"])["bins"]] if len(elite) else []
            best = evolve(sizes, known, length, hash((*map(int, key), epoch)))
            return pd.DataFrame({"shard": key[0], "island": key[1], "rank": range(len(best)), "n_bins": [int(b.max()) + 1 for b in best], "bins": [b.astype(np.int32) for b in best]})

        def first(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
            return bred(key, shard, pd.DataFrame())  # noqa: B023

        def later(key: tuple, shard: pd.DataFrame, elite: pd.DataFrame) -> pd.DataFrame:
            return bred(key, shard, elite)  # noqa: B023

        if state is None:
            new = homes.groupBy("shard", "island").applyInPandas(first, schema)
        else:
            moved = state.where("rank = 0").withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
            new = homes.groupBy("shard", "island").cogroup(state.union(moved).groupBy("shard", "island")).applyInPandas(later, schema)
        state = stored(new, "elites")
    return state.groupBy("shard").agg(F.min_by("bins", F.struct("n_bins", "island", "rank")).alias("bins"))


def _placed(rows: DataFrame, solutions: DataFrame, level: int, length: int) -> DataFrame:
    """The pieces with sequence_id, offset and the filling of their sequence."""

    def place(key: tuple, shard: pd.DataFrame, solution: pd.DataFrame) -> pd.DataFrame:
        shard = _shard(shard)
        if len(shard):
            bins = np.array(solution["bins"].iloc[0], np.int64)
            order = np.argsort(bins, kind="stable")
            shard, bins = shard.iloc[order], bins[order]
            before = np.cumsum(shard["length"].to_numpy()) - shard["length"].to_numpy()
            first = np.concatenate([[True], bins[1:] != bins[:-1]])
            start = np.maximum.accumulate(np.where(first, before, 0))
            shard = shard.assign(sequence_id=(level << 56) + (int(key[0]) << 20) + bins, offset=before - start, filled=_fills(shard["length"].to_numpy(), bins)[bins].astype(np.int64))
        else:
            shard = shard.assign(sequence_id=0, offset=0, filled=0)
        return shard[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "filled"]]

    return rows.groupBy("shard").cogroup(solutions.groupBy("shard")).applyInPandas(place, PIECES + ", sequence_id long, offset long, filled long")


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of ``docs`` (doc_id, text).

    A null or empty text is one piece that holds only the end mark. Null ids are kept;
    repeated rows are packed as often as they occur; other columns are not read.
    ``tokenizer`` and ``ranks`` are paths that every executor can read.
    """
    prepare(docs.sparkSession)
    rest = stored(pieces(docs, tokenizer, ranks, length), "pieces")
    columns = rest.columns
    done = []
    for level in range(LEVELS):
        n = rest.count()
        shards = max(1, -(-n // SHARD_PIECES))
        # By content, so that a task that is run again deals alike.
        rows = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.lit(level)), F.lit(shards)))
        placed = stored(_placed(rows, _bred(rows, length), level, length), "placed")
        if shards == 1 or level == LEVELS - 1:
            done.append(placed)
            break
        done.append(placed.where(F.col("filled") >= WELL_FILLED * length))
        rest = placed.where(F.col("filled") < WELL_FILLED * length).select(columns)
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out.drop("filled")
