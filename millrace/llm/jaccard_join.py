"""Exact Jaccard join of shingle sets by universe partition and pigeonhole.

Two sets of at least ``percent`` similarity, the larger of x elements, differ in at most
H = floor(2 x (100 - percent) / (100 + percent)) elements. Elements are dealt into m > H
segments by their hash, m by size band, so that both sets of a pair use the same m. If the
larger set picks segments with a tolerance v (0: equal, 1: one element more or fewer) such
that the sum of v + 1 is above H, one of them holds within its tolerance: exact.

1. Equal sets become one class, named by its smallest document; only classes are compared.
2. A class writes a key for each of its segments, in its own band and, if a larger set of
   the next band may be close, in that one. For one segment in ``NEIGHBOURS`` it also
   writes the segment with each one element left out, its one-deletion neighbourhood.
3. Only keys of several classes lead anywhere. Their numbers of classes are the costs: a
   class takes its H + 1 cheapest offers, each an equal segment or a neighbourhood. Offers
   that lead to nobody are free, so most classes need none of the others.
4. In a key that somebody took, all classes are compared with the one that shares most, on
   full sets. Where that leaves a key in several components, its classes are compared in tasks,
   blocks of them at a time over an inverted index; only links that join components leave.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.lookup import lookup_join
from millrace.session import configure, is_small

from . import arrays
from .frames import prepare, stored
from .minhash import _Search, _sets, linked, shingle_sets

WORDS = 4
PERCENT = 85
# Largest size of a band over that of the one below.
BAND = 1.5
# Keys that leave a task in one frame.
FRAME_KEYS = 200_000
# Counters that a comparison adds to at a time, and candidates up to which it compares set by set.
STEP = 1 << 20
FEW = 32
# Of so many segments one has its one-deletion neighbourhood written.
NEIGHBOURS = 24


def apart(size: int, percent: int) -> int:
    """Elements in which a set of ``size`` and one no larger may differ at most."""
    return 2 * size * (100 - percent) // (100 + percent)


@lru_cache(4096)
def band(size: int, percent: int) -> tuple[int, int, int, bool]:
    """(band, its segments, those of the next band, whether a larger set there may be close)."""
    top, k = 1, 0
    while top < size:
        top, k = max(top + 1, int(top * BAND)), k + 1
    above = max(top + 1, int(top * BAND))
    # The least larger set of the next band has top + 1 elements.
    return k, apart(top, percent) + 1, apart(above, percent) + 1, 100 * size >= percent * (top + 1)


def _segment_keys(s: np.ndarray, scheme: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the segments of a set, and (key, segment) of the neighbourhoods."""
    place = (arrays.mix(s ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    # A sum of spread hashes does not depend on the order of the elements.
    spread = arrays.mix(s * np.uint64(0xE7037ED1A0B428DB) + np.uint64(scheme))[order]
    ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=m))])
    total = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
    sums = total[ends[1:]] - total[ends[:-1]]
    salt = arrays.mix(np.arange(m, dtype=np.uint64) + np.uint64(scheme << 32))
    at = place[order][: ends[m // NEIGHBOURS]]
    return arrays.mix(sums ^ salt), np.stack([arrays.mix((sums[at] - spread[: len(at)]) ^ salt[at]), at.astype(np.uint64)])


def _keys(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set and their tags: segment * 4 + 2 if a neighbour + 1 if in the own band."""
    k, own, above, near = band(len(s), percent)
    keys, tags = [], []
    for scheme, m, mine in ((k, own, 1), (k + 1, above, 0))[: 1 + near]:
        if m == 1:
            continue  # no set other than an equal one is close
        exact, (neighbours, at) = _segment_keys(s, scheme, m)
        keys += [exact, neighbours]
        tags += [np.arange(m) * 4 + mine, at.astype(np.int64) * 4 + 2 + mine]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return arrays.signed(np.concatenate(keys)), np.concatenate(tags).astype(np.int32)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (a 128-bit digest of the set), m (segments), most (elements that may differ)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for s in _sets([arrays.utf8(t) for t in batch["text"]], words):
                other = arrays.mix(s * np.uint64(0x8EBC6AF09C88C6E3) + np.uint64(len(s)))
                digest = arrays.signed(np.array([arrays.mix(s).sum(), other.sum()], np.uint64)).tolist()
                rows.append((len(s), *digest, band(len(s), percent)[1], apart(len(s), percent)))
            out = pd.DataFrame(rows, columns=["n_shingles", "d1", "d2", "m", "most"], dtype=np.int64)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInPandas(sign, "doc_id long, n_shingles long, d1 long, d2 long, m long, most long")


def _frame(found: list[tuple]) -> pd.DataFrame:
    nodes = np.repeat([node for node, _, _ in found], [len(keys) for _, keys, _ in found])
    keys, tags = (np.concatenate([np.zeros(0, kind), *[f[k] for f in found]]) for k, kind in ((1, np.int64), (2, np.int32)))
    return pd.DataFrame({"node": nodes.astype(np.int64), "key": keys, "tag": tags})


def segment_keys(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, key, tag) of texts (node, text)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, held = [], 0
            for node, s in zip(batch["node"], _sets([arrays.utf8(t) for t in batch["text"]], words), strict=True):
                found.append((node, *_keys(s, percent)))
                held += len(found[-1][1])
                if held > FRAME_KEYS:
                    yield _frame(found)
                    found, held = [], 0
            yield _frame(found)

    return texts.mapInPandas(cut, "node long, key long, tag int")


def _taken(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """The keys that some class takes: for each its cheapest offers, as many as it needs.

    Of a node with several sets, each set's offers are picked from all of the node's, which
    picks no fewer of its own.
    """
    own = members.where(F.col("tag").bitwiseAND(1) == 1).select(
        "node", "key", "others", F.shiftright("tag", 2).alias("segment"), (F.col("tag").bitwiseAND(2) == 2).alias("neighbour")
    )
    # A segment offers two things: that it is equal, or (by all its keys) within one element.
    equal = F.max(F.when(~F.col("neighbour"), F.col("others")))
    offers = own.groupBy("node", "segment").agg(equal.alias("equal"), F.sum("others").alias("near"))
    near = F.floor(F.col("m") / NEIGHBOURS)
    kinds = F.array(
        F.when(F.col("equal").isNotNull(), F.struct(F.col("equal").alias("cost"), F.lit(False).alias("neighbour"))),
        F.when(F.col("segment") < near, F.struct(F.col("near").alias("cost"), F.lit(True).alias("neighbour"))),
    )
    plans = sizes.select("node", "m", "most").distinct().join(offers, "node")
    plans = plans.select("node", "segment", "m", "most", F.explode(F.array_compact(kinds)).alias("offer"))
    each = Window.partitionBy("node", "m", "most")
    free = F.col("m") + near - F.count("*").over(each)
    # An equal segment never costs more than its neighbourhood, which needs it.
    rank = F.row_number().over(each.orderBy("offer.cost", "offer.neighbour", "segment"))
    picked = plans.withColumn("needed", F.col("most") + 1 - free).withColumn("rank", rank).where("rank <= needed")
    picked = picked.select("node", "segment", "offer.neighbour").distinct()
    return own.join(picked, ["node", "segment", "neighbour"]).select("key").distinct()


def _block_links(groups: DataFrame, percent: int) -> DataFrame:
    """(x, y): links of each pair of blocks (group, side, two, node, root, shingles) that join components."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, group = [], None
        for batch in batches:
            for own, part in batch.groupby("group", sort=False):
                if held and own != group:
                    yield _compare(pd.concat(held), percent)
                    held = []
                held, group = [*held, part], own
        if held:
            yield _compare(pd.concat(held), percent)

    return groups.repartition("group").sortWithinPartitions("group").mapInPandas(find, "x long, y long")


def _postings(number: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each token one after the other, and where each token's begin."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=1))])
    return owner[np.argsort(number, kind="stable")], begin


def _count(tokens: np.ndarray, rows: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """How many of the tokens each row has, adding up STEP postings at a time."""
    out, length = np.zeros(n, np.int64), begin[tokens + 1] - begin[tokens]
    cuts = np.searchsorted(np.cumsum(length), np.arange(STEP, length.sum() + STEP, STEP), "right") if len(tokens) else []
    start = 0
    for end in [*np.unique(cuts).tolist(), len(tokens)]:
        for t in ([slice(start, end)] if end > start else []):
            own, size = begin[tokens[t]], length[t]
            places = np.repeat(own - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out += np.bincount(rows[places], minlength=n)
        start = max(start, end)
    return out


def _compare(block: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The links of one group that a spanning forest needs.

    Sets that are close share one of their rarest tokens; only rows with such a partner
    in another component are compared as a whole.
    """
    n, node = len(block), block["node"].to_numpy()
    two, side = bool(block["two"].iloc[0]), block["side"].to_numpy()
    sizes = np.fromiter(map(len, block["shingles"]), np.int64, n)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    _, number = np.unique(np.concatenate(list(block["shingles"])), return_inverse=True)
    often = np.bincount(number)
    # Tokens by rank, the rarest first, so that the least of a row are its rarest.
    rank = np.empty(len(often), np.int64)
    rank[np.lexsort((np.arange(len(often)), often))] = np.arange(len(often))
    tokens = [np.sort(rank[number[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    rare = [t[: len(t) - -(-len(t) * percent // 100) + 1] for t in tokens]
    first = _postings(np.concatenate(rare), np.array([len(t) for t in rare]))
    whole = _postings(np.concatenate(tokens), sizes)
    first = (first[0], np.pad(first[1], (0, len(often) + 1 - len(first[1])), "edge"))
    _, label = np.unique(block["root"].to_numpy(), return_inverse=True)
    out = []
    for i in range(n):
        if two and side[i]:
            continue
        partner = (label != label[i]) & (side if two else np.arange(n) > i)
        partner &= (100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes)
        near = np.flatnonzero(partner & (_count(rare[i], *first, n) > 0)) if partner.any() else []
        if len(near) > FEW:
            both = _count(tokens[i], *whole, n)[near]
        else:
            both = np.array([len(np.intersect1d(tokens[i], tokens[j], assume_unique=True)) for j in near], np.int64)
        for j in np.asarray(near, np.int64)[100 * both >= percent * (sizes[near] + sizes[i] - both)].tolist() if len(near) else []:
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                out.append((node[i], node[j]))
    return pd.DataFrame(out, columns=["x", "y"], dtype=np.int64)


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    A text's set has its distinct ``words``-word shingles of the lower-cased (A-Z) words; the
    whole sequence if it is shorter. Texts link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id that a document reaches by links, no link is missed.
    A null, empty or blank text has no shingle and is linked with nothing. Rows with a null
    doc_id link nothing and have a null component. Rows that repeat a doc_id are one node.
    Other columns are ignored; an empty table gives none.
    """
    prepare(configure(docs.sparkSession))
    rows = stored(signatures(docs, words, percent), "signatures")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), *[F.first(x).alias(x) for x in ("n_shingles", "m", "most")])
    classes = stored(classes, "classes")
    # Copies of a class need no keys. An id may have several texts, one of which names a class.
    named = full.select("doc_id", "d1", "d2").distinct()
    copies = named.join(classes.select("d1", "d2", "node"), ["d1", "d2"]).where("doc_id != node").select(F.col("doc_id").alias("node"))
    copies = stored(copies.join(classes.select("node"), "node", "left_anti").distinct(), "copies")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where("node is not null")
    texts = texts.join(F.broadcast(copies) if is_small(copies) else copies, "node", "left_anti")

    keys = segment_keys(texts, words, percent)
    often = keys.groupBy("key").agg((F.count("*") - 1).alias("others")).where("others > 0")
    members = stored(lookup_join(keys, often, "key", "inner"), "members")
    taken = lookup_join(members.select("key", "node"), _taken(members, classes), "key", "inner")
    taken = stored(taken.distinct(), "taken")
    # The class that shares most is compared with the others: an original, rather than one of its copies.
    shared = lookup_join(taken, members.groupBy("node").agg(F.sum("others").alias("shared")), "node", "inner")
    hub = shared.groupBy("key").agg(F.max_by("node", F.struct("shared", "node")).alias("x"), F.min("node").alias("low"), F.max("node").alias("last"))
    members = stored(lookup_join(taken, hub.where("low < last").select("key", "x"), "key", "inner"), "candidates")
    sets = stored(shingle_sets(texts.join(members.select("node").distinct(), "node", "left_semi"), words), "sets")
    search = _Search(classes.select("node", F.col("n_shingles").alias("n")), sets)
    search.add(linked(members.where("x != node").select("x", F.col("node").alias("y")).distinct(), sets, percent))
    search.add(_block_links(search.families(members.select("key", "node")), percent))

    label = classes.join(search.roots, "node", "left").groupBy("d1", "d2").agg(F.min(F.coalesce("root", "node")).alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return lookup_join(rows, label, ["d1", "d2"]).select("doc_id", "n_shingles", component.alias("component_id"))


def oracle() -> str:
    """The same in DuckDB's SQL: pairs by shared shingles, components by reached documents."""
    shingle = " || ' ' || ".join(f"words[i + {k}]" for k in range(WORDS))
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - {WORDS - 2}), lambda i: {shingle})) END AS shingles FROM texts
),
each_shingle AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM each_shingle a JOIN each_shingle b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reached r JOIN both_ways l ON l.x = r.other)
SELECT s.doc_id, len(s.shingles) AS n_shingles, c.component_id FROM sets s
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c ON c.doc_id = s.doc_id
"""
