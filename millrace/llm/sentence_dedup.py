"""Repeated sentences, found as sliding spans.

A text is cut behind its sentences, and by content inside them: before each word whose
hash is the least in some window of CUT words. So every CUT words have a cut, and where
it is depends on the words around it alone: text without punctuation, or a passage that
begins in the middle of a sentence, is cut at the same words wherever it stands.

With ``every``, as the query asks for, a span starts at every piece: no window of pieces is left
out. Else a span starts at a text's first word and before each word that is the least in some window
of START words, and runs to the first cut that leaves it LEAST words and SPAN pieces. Any
passage of 51 words has one whole in it: the windows that reach over its border decide
about its first and last 10 words at most (5 for cuts), a start is among its words 11 to
21, and its span ends within 25 words, before word 46. A text too short for a span is one
span, and the last span of a text is there to the end of the text, too, so copies go whole.
Of equal spans anywhere in the corpus the first stays, and the pieces of all others go.

What repeats within a text is found where the text is; only the first of its equal spans moves. Spans
are counted where they are read, then globally; only repeated ones are looked at again, in a join that
Spark splits on a hot span. The counts are written before that join, so the two largest shuffles are
never on disk together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup_join
from millrace.session import configure

from . import arrays
from .frames import packed, prepare, stored, unpacked

SPAN = 3
LEAST = 20
CUT = 6
START = 11
# A span has fewer pieces, as every CUT words and at most LEAST + START words have one.
PIECES = 64

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def _least(word: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Whether each word is the least in some window of ``size`` words of its text."""
    n = len(word) - size + 1
    if n < 1:
        return np.zeros(len(word), bool)
    low = word[:n].copy()
    for k in range(1, size):
        np.minimum(low, word[k : n + k], out=low)
    low[text[:n] != text[size - 1 :]] = 0
    best = np.zeros(len(word), np.uint64)
    for k in range(size):
        np.maximum(best[k : n + k], low, out=best[k : n + k])
    return (best == word) & (best > 0)


class Sentences:
    """The pieces of many texts: first and end byte in the text, and where each text's begin.

    Words are runs without white space (ASCII). A sentence ends with a word that ends in
    one of .!?, before a line break and with the text.
    """

    def __init__(self, values: list[bytes], every: bool = False):
        data, starts = arrays.join(values)
        inside = np.concatenate([[False], ~arrays.SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        self.word = arrays.Rolling(data).of(first, last)
        # A line break lies behind each text, too.
        breaks = np.concatenate([[0], np.cumsum(data == ord("\n"))])
        behind = np.append(first[1:], len(data)) if len(first) else first
        ends = _END[data[last - 1]] | (breaks[behind] > breaks[last]) if len(first) else np.zeros(0, bool)
        text = np.searchsorted(starts, first, "right")
        opens = np.concatenate([[True], text[1:] != text[:-1]]) if len(first) else ends
        is_start = opens | _least(self.word, text, START)
        begins = np.concatenate([[True], ends[:-1]]) if len(first) else ends
        self.begins = np.flatnonzero(begins | is_start | _least(self.word, text, CUT))
        stops = np.append(self.begins[1:], len(self.word)) if len(self.begins) else self.begins
        self.bounds = np.searchsorted(first[self.begins], starts)
        self.starts = np.arange(len(self.begins)) if every else np.flatnonzero(is_start[self.begins])
        origin = np.repeat(starts[:-1], np.diff(self.bounds))
        self.first, self.last = first[self.begins] - origin, last[stops - 1] - origin

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first piece in it, pieces, hash, another hash) of each span."""
        edges = np.append(self.begins, len(self.word))
        text = np.searchsorted(self.bounds, self.starts, "right") - 1
        open_, close = self.bounds[text], self.bounds[text + 1]
        stop = np.maximum(np.searchsorted(edges, edges[self.starts] + LEAST), self.starts + SPAN)
        fits = stop <= close
        # The last start of a text from which a span fits, and the first where none does.
        follows = np.append(fits[1:] & (text[1:] == text[:-1]), False) if len(text) else fits
        tail = fits & ~follows & (stop < close)
        whole = ~fits & (self.starts == open_)
        start = np.concatenate([self.starts[fits], self.starts[tail | whole]])
        stop = np.concatenate([stop[fits], close[tail | whole]])
        which = np.concatenate([text[fits], text[tail | whole]])
        other = arrays.mix(self.word ^ np.uint64(0x9E3779B97F4A7C15))
        hashes = [arrays.Rolling(w).of(edges[start], edges[stop]) for w in (self.word, other)]
        return which, start - self.bounds[which], stop - start, *hashes

    @staticmethod
    def again(which: np.ndarray, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Whether each span repeats an earlier one of its text; depends on that text alone."""
        order = np.lexsort((h, which))
        same = np.zeros(len(which), bool)
        a, b = order[:-1], order[1:]
        same[b] = (which[a] == which[b]) & (h[a] == h[b]) & (check[a] == check[b])
        return same


def sentences(text: bytes) -> list[tuple[int, int]]:
    """(first, end) byte of each piece of one text; what is between them belongs to none."""
    found = Sentences([text])
    return list(zip(found.first.tolist(), found.last.tolist(), strict=True))


def _spans(texts: DataFrame, every: bool) -> DataFrame:
    """(h, check, doc_id, d, at) of each span, once for each text; ``at`` is its first piece and the number of pieces."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [arrays.utf8(t) for t in batch["text"]]
            ids = batch["doc_id"].to_numpy()
            for i, j in arrays.chunks(values):
                found = Sentences(values[i:j], every).spans()
                once = ~Sentences.again(found[0], *found[3:])
                which, at, pieces, h, check = (x[once] for x in found)
                crc = np.array([zlib.crc32(v) for v in values[i:j]], np.uint32).view(np.int32)
                columns = {"h": arrays.signed(h), "check": (check >> np.uint64(33)).astype(np.int32), "doc_id": ids[i:j][which], "d": crc[which], "at": at * PIECES + pieces}
                yield pd.DataFrame(columns)

    return texts.mapInPandas(find, "h long, check int, doc_id long, d int, at long")


def remove_repeated_sentences(docs: DataFrame, every: bool = False) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_spans, kept_sha256, kept for each row of ``docs`` (doc_id, text).

    n_sentences counts the pieces, n_removed those covered by a span that also starts earlier, in
    a smaller document or earlier in the same one; n_spans the stretches they form. kept is
    the text without them. A text of fewer than LEAST words or SPAN pieces is one span, so it goes
    if there is an equal one before. A null text counts as empty, and an empty or blank one has
    no piece. Rows with a null doc_id are
    compared with nothing and stay whole. Rows that repeat a doc_id with another text are
    ordered by the crc32 of the text (signed); rows that repeat both get the same answer. Other
    columns are not read.

    With ``every`` a span starts at every piece, so that every window of SPAN pieces in a row
    (more, where they have fewer than LEAST words) is compared; else only at chosen words.
    """
    prepare(configure(docs.sparkSession))
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    spans, key = _spans(docs.where("doc_id is not null"), every), ["h", "check"]
    often = spans.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    often = stored(often, "spans-often", clean=True)
    met = stored(lookup_join(spans, often, key, "inner"), "repeated-spans", clean=True)
    # Within the first document only its first place stays.
    place = F.struct("d", "at")
    own = met.where("doc_id = first")
    earliest = own.groupBy(*key).agg(F.min(place).alias("place"))
    again = met.where("doc_id > first").drop("first").union(
        lookup_join(own, earliest, key, "inner").where(place > F.col("place")).drop("first", "place")
    )
    # One document's spans.
    again = again.groupBy("doc_id", "d").agg(F.collect_set("at").alias("again"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            values, has_id = list(unpacked(batch["body"])), batch["doc_id"].notna().to_numpy()
            for i, j in arrays.chunks(values):
                found = Sentences(values[i:j], every)
                which, first, pieces, h, check = found.spans()
                own = np.flatnonzero(Sentences.again(which, h, check))
                own = own[np.argsort(which[own], kind="stable")]
                inner, edges = (first * PIECES + pieces)[own], np.searchsorted(which[own], np.arange(j - i + 1))
                for k in range(i, j):
                    a, b = found.bounds[k - i], found.bounds[k - i + 1]
                    gone = np.zeros(b - a + 1, np.int64)
                    if has_id[k]:
                        far = batch["again"].iloc[k]
                        at = np.concatenate([inner[edges[k - i] : edges[k - i + 1]], np.asarray([] if far is None else far, np.int64)])
                        np.add.at(gone, at // PIECES, 1)
                        np.subtract.at(gone, at // PIECES + at % PIECES, 1)
                    gone = (np.cumsum(gone)[: b - a] > 0).astype(np.int64)
                    kept, begin = [], 0
                    for x in np.flatnonzero(gone) + a:
                        kept.append(values[k][begin : found.first[x]])
                        begin = found.last[x]
                    left = b"".join([*kept, values[k][begin:]])
                    n_spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
                    out.append((b - a, int(gone.sum()), n_spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass")))
            result = pd.DataFrame(out, columns=["n_sentences", "n_removed", "n_spans", "kept_sha256", "kept"])
            result.insert(0, "doc_id", batch["doc_id"].array)
            yield result

    return (
        packed(docs)
        .withColumn("d", F.when(F.col("d") < 1 << 31, F.col("d")).otherwise(F.col("d") - (1 << 32)).cast("int"))
        .join(again, ["doc_id", "d"], "left")
        .select("doc_id", "body", "again")
        .mapInPandas(finish, "doc_id long, n_sentences long, n_removed long, n_spans long, kept_sha256 string, kept string")
    )
