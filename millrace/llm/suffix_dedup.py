"""Repeated byte strings, found by sorting suffixes in buckets.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier: in a
smaller document, or earlier in the same one. Equal strings have to meet in one
bucket, and one bucket has to fit a task.

* **Buckets.** Each LENGTH-byte string has an anchor: the first of the smallest hashes
  of its GRAM-byte pieces. Equal strings have equal anchors at equal places, so the
  suffix bucket of a string is the hash of its anchor. Neighbouring strings mostly share
  their anchor; such a run moves as one row, about one for 35 bytes of text.
* **Runs that are equal as a whole** need no sorting: all but the first are repeats.
  They are set aside block by block where they are read, so a passage that a third of
  all documents share reaches its bucket a few times only, and again in the bucket.
* **Buckets whose runs differ** get their text. A task sorts the suffixes of one bucket
  at a time (small ones together): every suffix that starts at a position 1 or 2 modulo
  3, a difference cover, is ranked beforehand by doubling; the order of any two suffixes,
  however long their common start, then follows from at most two bytes and the ranks of
  the cover positions behind them. Neighbours in that order that agree in LENGTH bytes
  are one string, of which the first start is kept.
* **Buckets of more than HOT_RUNS runs** (one line in very many texts, with other text
  around it each time) would not fit. Their strings are buckets of their own, named by a
  hash of all LENGTH bytes, and go through the second step again, one string to a row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import arrays
from .frames import packed, prepare, stored, unpacked

LENGTH = 100
GRAM = 32
# Text whose equal runs are set aside together, and text that is sorted together.
BLOCK_BYTES = 32 << 20
SORT_BYTES = 1 << 19
HOT_RUNS = 20_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(values: list[bytes], length: int = LENGTH, gram: int = GRAM) -> pd.DataFrame:
    """Runs of string starts with one anchor: row (of values), p0, n, off (of the anchor), h, rh."""
    data, starts = arrays.join(values)
    none = pd.DataFrame({k: np.zeros(0, np.int64) for k in ("row", "p0", "n", "off", "h", "rh")})
    width = length - gram + 1
    if len(data) < length:
        return none
    rolling = arrays.Rolling(data)
    grams = rolling.grams(gram)
    bits = np.uint64(len(data).bit_length())
    place = np.arange(len(grams), dtype=np.uint64)
    anchor = _sliding_min((grams >> bits << bits) | place, width) & ((np.uint64(1) << bits) - np.uint64(1))
    # Starts of strings within one value.
    inside = np.zeros(len(anchor) + 1, np.int64)
    sizes = np.diff(starts) - 1
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return none
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, np.minimum(starts[long] + sizes[long] - length + 1, len(anchor)), -1)
    p = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    a = anchor[p].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 0) | (np.diff(p) != 1)]))
    n = np.diff(np.concatenate([new, [len(p)]]))
    p0, a = p[new], a[new]
    row = np.searchsorted(starts, p0, "right") - 1
    rh = arrays.mix(rolling.of(p0, p0 + n - 1 + length) + (a - p0).astype(np.uint64))
    return pd.DataFrame({"row": row, "p0": p0 - starts[row], "n": n, "off": a - p0, "h": arrays.signed(grams[a]), "rh": arrays.signed(rh)})


def _merged(doc: np.ndarray, d: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Removed ranges, those that touch joined."""
    order = np.lexsort((start, d, doc))
    doc, d, start, end = doc[order], d[order], start[order], end[order]
    if len(doc):
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (d[1:] != d[:-1]) | (start[1:] > end[:-1])])
        first = np.flatnonzero(new)
        doc, d, start, end = doc[first], d[first], start[first], np.maximum.reduceat(end, first)
    return pd.DataFrame({"doc_id": doc, "d": d, "start": start, "end": end})


def _set_aside(found: list[pd.DataFrame], length: int) -> pd.DataFrame:
    """The first of each equal run of a block; of the others only the ranges they remove."""
    x = pd.concat(found, ignore_index=True).sort_values(["h", "rh", "doc_id", "d", "p0"], ignore_index=True)
    again = np.zeros(len(x), bool)
    if len(x):
        again[1:] = (x["h"].to_numpy()[1:] == x["h"].to_numpy()[:-1]) & (x["rh"].to_numpy()[1:] == x["rh"].to_numpy()[:-1])
    y = x[again]
    gone = _merged(y["doc_id"].to_numpy(), y["d"].to_numpy(), y["p0"].to_numpy(), (y["p0"] + y["n"] - 1 + length).to_numpy())
    gone["h"] = arrays.signed(arrays.mix(gone["doc_id"].to_numpy().astype(np.uint64) + gone["start"].to_numpy().astype(np.uint64)))
    kept = x[~again].assign(rh=lambda f: f["rh"].astype("Int64"), start=lambda f: f["p0"], end=lambda f: f["n"] * 256 + f["off"])
    return pd.concat([kept, gone.assign(rh=pd.array([pd.NA] * len(gone), "Int64"))])[["h", "rh", "doc_id", "d", "start", "end"]]


def _all_runs(docs: DataFrame, length: int) -> DataFrame:
    """h, rh, doc_id, d, start, end: a run (end holds n and off), or with a null rh a removed range."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            values = [arrays.utf8(t) for t in batch["text"]]
            ids = batch["doc_id"].to_numpy()
            crc = np.fromiter((zlib.crc32(v) for v in values), np.int64, len(values))
            for i, j in arrays.chunks(values):
                x = runs(values[i:j], length)
                row = x.pop("row").to_numpy() + i
                held.append(x.assign(doc_id=ids[row], d=crc[row]))
                size += sum(map(len, values[i:j]))
                if size >= BLOCK_BYTES:
                    yield _set_aside(held, length)
                    held, size = [], 0
        if held:
            yield _set_aside(held, length)

    return docs.mapInPandas(find, "h long, rh long, doc_id long, d long, start long, end long")


def cover_order(data: np.ndarray, depth: int) -> np.ndarray:
    """The rank of every suffix of ``data`` by at least its first ``depth`` bytes.

    Suffixes that agree in more may come in any order among themselves. Positions 1 and
    2 modulo 3 are ranked by doubling; the others by one byte and the rank behind it, and
    merged with both kinds by one or two bytes and the rank behind those.
    """
    n = -(-len(data) // 3) * 3
    text = np.zeros(n + 6 * (depth + 6), np.int64)
    text[: len(data)] = data
    text[: len(data)] += 1
    at = np.arange(len(text))
    cover = at[: len(text) - 6][at[: len(text) - 6] % 3 != 0]
    key = np.zeros(len(cover), np.int64)
    for k in range(6):
        key = key * 512 + text[cover + k]
    rank = np.zeros(len(text) + 2 * depth + 12, np.int64)
    reach = 6
    while True:
        _, place = np.unique(key, return_inverse=True)
        rank[cover] = place + 1
        if reach >= depth:
            break
        key = rank[cover] * (len(cover) + 2) + rank[cover + reach]
        reach *= 2
    m = len(cover) + 2
    zero = at[:n:3]
    one, two = zero + 1, zero + 2
    out = np.zeros(n, np.int64)
    z1 = text[zero] * m + rank[zero + 1]
    z2 = (text[zero] * 512 + text[zero + 1]) * m + rank[zero + 2]
    o1 = text[one] * m + rank[one + 1]
    t2 = (text[two] * 512 + text[two + 1]) * m + rank[two + 2]
    s1, so, s2, st = np.sort(z1), np.sort(o1), np.sort(z2), np.sort(t2)
    covered = np.sort(np.concatenate([rank[one], rank[two]]))
    out[zero] = np.searchsorted(s1, z1) + np.searchsorted(so, z1) + np.searchsorted(st, z2)
    out[one] = np.searchsorted(covered, rank[one]) + np.searchsorted(s1, o1)
    out[two] = np.searchsorted(covered, rank[two]) + np.searchsorted(s2, t2)
    return out[: len(data)]


def repeats(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """The removed ranges of one block of whole buckets (doc_id, d, start, n, body)."""
    rows = rows.sort_values(["doc_id", "d", "start"], ignore_index=True)
    data, starts = arrays.join(list(rows["body"]), b"\0" * 8)
    n = rows["n"].to_numpy()
    which = np.repeat(np.arange(len(rows)), n)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    p = starts[:-1][which] + step
    # Windows are in order of their starts, so equal ranks keep it.
    order = np.argsort(cover_order(data, length)[p], kind="stable")
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    words = np.ascontiguousarray(eight).view(np.uint64).ravel()
    x, y = p[order[:-1]], p[order[1:]]
    same = np.ones(len(x), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        same &= words[x + k] == words[y + k]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    lowest = np.minimum.reduceat(order, first)
    again = np.ones(len(p), bool)
    again[lowest] = False
    which, step = which[again], step[again]
    start = rows["start"].to_numpy()[which] + step
    return _merged(rows["doc_id"].to_numpy()[which], rows["d"].to_numpy()[which], start, start + length)


def _stretches(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The text of the wanted runs: h, doc_id, d, start, n, body."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, d, text, asked in zip(batch["doc_id"], batch["d"], unpacked(batch["body"]), batch["asked"], strict=True):
                for x in asked:
                    n = x["end"] >> 8
                    out.append((x["h"], doc_id, d, x["start"], n, text[x["start"] : x["start"] + n - 1 + length]))
            yield pd.DataFrame(out, columns=["h", "doc_id", "d", "start", "n", "body"])

    # At most one entry for 35 bytes or so of one document.
    by_doc = wanted.groupBy("doc_id", "d").agg(F.collect_list(F.struct("h", "start", "end")).alias("asked"))
    return packed(docs).join(by_doc, ["doc_id", "d"]).mapInPandas(cut, "h long, doc_id long, d long, start long, n long, body binary")


def _sorted_repeats(stretches: DataFrame, length: int) -> DataFrame:
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole buckets, about SORT_BYTES at a time."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch["body"].map(len).sum()
            if size >= SORT_BYTES:
                x = pd.concat(held, ignore_index=True)
                h = x["h"].to_numpy()
                last = np.flatnonzero(h != h[-1])
                held, size = [x], 0
                if len(last):  # the last bucket may go on
                    cut = last[-1] + 1
                    yield x[:cut]
                    held, size = [x[cut:]], x["body"][cut:].map(len).sum()
        if held:
            yield pd.concat(held, ignore_index=True)

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            if len(block):
                yield repeats(block, length)

    return (
        stretches.repartition("h").sortWithinPartitions("h").mapInPandas(sort, "doc_id long, d long, start long, end long")
    )


def _hot_windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """As ``_all_runs``, each string of the wanted runs as a run of its own."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for doc_id, d, text, asked in zip(batch["doc_id"], batch["d"], unpacked(batch["body"]), batch["asked"], strict=True):
                rolling = arrays.Rolling(np.frombuffer(text, np.uint8))
                p = np.concatenate([np.arange(x["start"], x["start"] + (x["end"] >> 8)) for x in asked])
                h = rolling.of(p, p + length)
                rest = arrays.mix(rolling.of(p, p + length // 2) ^ np.uint64(length))
                held.append(pd.DataFrame({"p0": p, "n": 1, "off": 0, "h": arrays.signed(h), "rh": arrays.signed(rest), "doc_id": doc_id, "d": d}))
                size += 16 * len(p)
            if size >= BLOCK_BYTES:
                yield _set_aside(held, length)
                held, size = [], 0
        if held:
            yield _set_aside(held, length)

    by_doc = wanted.groupBy("doc_id", "d").agg(F.collect_list(F.struct("start", "end")).alias("asked"))
    return packed(docs).join(by_doc, ["doc_id", "d"]).mapInPandas(cut, "h long, rh long, doc_id long, d long, start long, end long")


def _judged(runs: DataFrame, length: int) -> DataFrame:
    """Of all runs those that repeat (as removed ranges) and those of buckets with several kinds."""
    w = Window.partitionBy("h")
    repeat = F.coalesce(F.col("before") == F.col("rh"), F.lit(False))
    kind = (
        F.when(F.col("rh").isNull() | F.col("repeat"), "range")
        .when(F.col("low") < F.col("high"), F.when(F.col("runs") > HOT_RUNS, "hot").otherwise("differs"))
    )
    end = F.when(F.col("repeat"), F.col("start") + F.shiftright("end", 8) + F.lit(length - 1)).otherwise(F.col("end"))
    return (
        runs.withColumn("before", F.lag("rh").over(w.orderBy("rh", "doc_id", "d", "start")))
        .withColumns({"low": F.min("rh").over(w), "high": F.max("rh").over(w), "runs": F.count("rh").over(w)})
        .withColumn("repeat", repeat)
        .withColumn("kind", kind)
        .where("kind is not null")
        .select("doc_id", "d", "start", end.alias("end"), "h", "kind")
    )


def removed_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, d (crc32 of the text), start, end: byte ranges that repeat an earlier string."""
    columns = ["doc_id", "d", "start", "end"]
    found = stored(_judged(_all_runs(docs, length), length), "equal-runs")
    text = _stretches(docs, found.where("kind = 'differs'"), length)
    ranges = found.where("kind = 'range'").select(columns).union(_sorted_repeats(text, length))
    hot = found.where("kind = 'hot'")
    if not hot.isEmpty():
        windows = _judged(_hot_windows(docs, hot, length), length)
        ranges = ranges.union(windows.where("kind = 'range'").select(columns))
    return ranges


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) for each row.

    ``docs`` has doc_id and text; other columns are ignored. A null text counts as empty.
    Rows with a null doc_id are compared with nothing and stay whole. Rows that repeat a
    doc_id with another text are told apart and ordered by the crc32 of the text; rows
    that repeat both are the same document and get the same answer.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    named = docs.where("doc_id is not null")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, ranges in zip(unpacked(batch["body"]), batch["ranges"], strict=True):
                kept, at, spans = [], 0, 0
                reach = -1
                for x in sorted((x["start"], x["end"]) for x in ranges) if ranges is not None else ():
                    if x[0] > reach:
                        spans += 1
                        if reach >= 0:
                            at = reach
                        kept.append(text[at : x[0]])
                    reach = max(reach, x[1])
                kept.append(text[max(reach, 0) :])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
            result = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            result.insert(0, "doc_id", batch["doc_id"].array)
            yield result

    # One document's ranges; a run for 35 bytes or so at most.
    ranges = removed_ranges(named, length).groupBy("doc_id", "d").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return (
        packed(docs)
        .join(ranges, ["doc_id", "d"], "left")
        .select("doc_id", "body", "ranges")
        .mapInPandas(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    )
