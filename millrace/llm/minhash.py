"""Near duplicates by MinHash with tensored banding.

A table key is a pair: one entry of a small collection of hashes and one of another. A
has A_TABLES entries of two minhashes, B has B_TABLES of one, so A_TABLES x B_TABLES
tables of three values each need only 2 * A_TABLES + B_TABLES minhashes. Two sets of
similarity t share a key unless no A entry or no B entry agrees: with 12 and 8, at
t = 0.75 that happens for 7 pairs in 100,000, at t = 0.8 for 7 in a million.

1. Texts become sets of shingle hashes; equal sets become one class, named by its
   smallest document. Only classes are compared, so exact copies cost nothing.
2. A key's classes are not paired with each other but with the key's smallest class;
   what is linked needs no more.
3. Classes of keys that are still in several components need more: any two of a key may
   be linked. An exact filter narrows them down: a set whose overlap with another must
   reach 75 % shares one of its rarest quarter of shingles with it. Classes that share such
   shingles form families, and a family is compared inside a task over an inverted index:
   only links that join components leave it. Families above BLOCK_SHINGLES are dealt in
   blocks, each pair of blocks to a task, so no task grows with a family.
4. A pair counts when the full sets say so. Sizes that rule it out are not compared.
5. Links are joined to components by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import arrays
from .frames import prepare, stored

WORDS = 5
PERCENT = 75
A_TABLES = 12
B_TABLES = 8
# Columns of the minhash table that are computed at a time.
COLUMNS = 4096
# Shingles of a block of a family; a task holds two blocks.
BLOCK_SHINGLES = 2_000_000


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = arrays.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def _sets(values: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each value."""
    for start, end in arrays.chunks(values):
        hashes, bounds = arrays.words(values[start:end], lower=True)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(arrays.shingles(hashes[a:b], words))


def _minhashes(s: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    low = np.full(len(factor), np.uint64(2**64 - 1))
    for at in range(0, len(s), COLUMNS):
        low = np.minimum(low, (factor[:, None] * s[at : at + COLUMNS] + shift[:, None]).min(1))
    return arrays.mix(low)


def _folded(x: np.ndarray, size: int) -> list[int]:
    """One hash for each ``size`` consecutive values."""
    x = x.reshape(-1, size)
    out = x[:, 0]
    for k in range(1, size):
        out = arrays.mix(out * np.uint64(0xD1342543DE82EF95) + x[:, k])
    return arrays.signed(np.ascontiguousarray(out)).tolist()


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (a 128-bit digest of the set), a and b (the two collections)."""
    n = 2 * A_TABLES + B_TABLES

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factor, shift = _multipliers(n)
        for batch in batches:
            rows = []
            for s in _sets([arrays.utf8(t) for t in batch["text"]], words):
                if not len(s):
                    rows.append((0, 0, 0, [], []))
                    continue
                a, b = np.split(_minhashes(s, factor, shift), [2 * A_TABLES])
                order = np.arange(1, len(s) + 1, dtype=np.uint64)
                digest = np.array([arrays.mix(s + order).sum(), arrays.mix(s ^ (order * factor[0])).sum()], np.uint64)
                rows.append((len(s), *arrays.signed(digest).tolist(), _folded(a, 2), _folded(b, 1)))
            out = pd.DataFrame(rows, columns=["n_shingles", "d1", "d2", "a", "b"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        sign, "doc_id long, n_shingles long, d1 long, d2 long, a array<long>, b array<long>"
    )


def _table_keys(classes: DataFrame) -> DataFrame:
    """(key, node): the tensor of both collections."""
    pair = F.expr("flatten(transform(a, (x, i) -> transform(b, (y, j) -> xxhash64(i, j, x, y))))")
    return classes.select(F.explode(pair).alias("key"), "node")


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, shingles) of texts (node, text)."""

    def with_set(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [arrays.signed(s) for s in _sets([arrays.utf8(t) for t in batch["text"]], words)]
            yield pd.DataFrame({"node": batch["node"].array, "shingles": pd.Series(sets, dtype=object)})

    return texts.mapInPandas(with_set, "node long, shingles array<long>")


def _rare_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node): of each set the rarest shingles, one of which any set close enough shares."""
    each = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("often")).where("often > 1")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("often", "key"))
    # Shingles of one set only are the rarest of all and lead to nobody.
    alone = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    least = F.ceil(F.col("n") * percent / 100)
    ranked = each.join(often, "key").select("key", "node", (rank + alone <= F.col("n") - least + 1).alias("wanted"))
    return ranked.where("wanted").select("key", "node")


def linked(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (x, y) of ``pairs`` whose full sets (node, shingles) have at least ``percent`` in common.

    y's set comes first, then it meets x's; the join on x is split by Spark where one x
    has many partners.
    """
    both = F.size(F.array_intersect("s", "t"))
    return (
        pairs.join(sets.select(F.col("node").alias("y"), F.col("shingles").alias("t")), "y")
        .join(sets.select(F.col("node").alias("x"), F.col("shingles").alias("s")), "x")
        .where(100 * both >= percent * (F.size("s") + F.size("t") - both))
        .select("x", "y")
        .distinct()
    )


def _with_fingerprint(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``edges`` stored, and their number and sum of hashes, from the same job."""
    seen = Observation()
    kept = stored(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), name)
    return kept, tuple(seen.get.values())


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of a link the smallest node that it reaches.

    Each round hangs every neighbourhood below its smallest node, first the larger
    neighbours, then the smaller; rounds grow with the logarithm of the longest path.
    """
    edges, before = _with_fingerprint(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u != v").distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges, after = _with_fingerprint(small, "links")
        if after == before:
            return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct()), "roots")
        before = after


class _Search:
    """Components found so far among classes, and the keys whose classes are still apart."""

    def __init__(self, sizes: DataFrame, sets: DataFrame):
        self.sizes, self.sets = sizes, sets
        self.roots: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """Join the components of the verified (x, y)."""
        if self.roots is None:
            self.roots = components(links)
            return
        # Only the components that a new link joins are named anew.
        for end in ("x", "y"):
            root = self.roots.select(F.col("node").alias(end), F.col("root").alias("r"))
            links = links.join(root, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
        moved = components(links).select(F.col("node").alias("root"), F.col("root").alias("new"))
        known = self.roots.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
        new = moved.select(F.col("root").alias("node"), F.col("new").alias("root")).join(self.roots, "node", "left_anti")
        self.roots = stored(known.union(new), "roots")

    def apart(self, members: DataFrame) -> DataFrame:
        """(key, node, low): of the keys whose classes are in several components; low is the smallest class."""
        rows = members.join(self.roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        mixed = (
            rows.groupBy("key")
            .agg(F.min("root").alias("a"), F.max("root").alias("z"), F.min("node").alias("low"))
            .where("a < z")
            .select("key", "low")
        )
        return rows.join(mixed, "key").select("key", "node", "low")

    def families(self, members: DataFrame) -> DataFrame:
        """(group, side, node, root, shingles): the classes that share keys, by pairs of blocks."""
        edges = self.apart(members).select(F.col("node").alias("y"), F.col("low").alias("x")).distinct()
        family = components(edges).select("node", F.col("root").alias("family"))
        named = family.join(self.sizes, "node").join(self.roots, "node", "left").select("family", "node", "n", F.coalesce("root", "node").alias("root"))
        blocks = named.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
        placed = named.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        low, high = F.least("block", "other"), F.greatest("block", "other")
        return dealt.select(
            F.xxhash64("family", low, high).alias("group"), (F.col("block") != low).alias("side"), (low != high).alias("two"), "node", "root"
        ).join(self.sets, "node")


def _family_links(groups: DataFrame, percent: int) -> DataFrame:
    """(x, y): links in each pair of blocks that join components."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            group = batch["group"].to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1), len(group)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and b > a and held[-1]["group"].iloc[0] != group[a]:
                    yield _links_within(pd.concat(held), percent)
                    held = []
                held.append(batch[a:b])
        if held:
            yield _links_within(pd.concat(held), percent)

    return groups.repartition("group").sortWithinPartitions("group").mapInPandas(find, "x long, y long")


def _links_within(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The links of one group that a spanning forest needs, from overlaps by inverted index."""
    node, two = rows["node"].to_numpy(), bool(rows["two"].iloc[0]) if len(rows) else False
    side = rows["side"].to_numpy()
    sizes = np.fromiter(map(len, rows["shingles"]), np.int64, len(rows))
    owner = np.repeat(np.arange(len(rows)), sizes)
    every = np.concatenate(list(rows["shingles"])) if len(rows) else np.zeros(0, np.int64)
    _, number = np.unique(every, return_inverse=True)
    by_shingle = np.argsort(number, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(number))])
    postings = owner[by_shingle]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    _, first, root = np.unique(rows["root"].to_numpy(), return_index=True, return_inverse=True)
    parent = list(range(len(first)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(len(rows)):
        if two and side[i]:
            continue
        own = number[ends[i] : ends[i + 1]]
        length = begin[own + 1] - begin[own]
        places = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        both = np.bincount(postings[places], minlength=len(rows))
        close = 100 * both >= percent * (sizes + sizes[i] - both)
        for j in np.flatnonzero(close & (side if two else np.arange(len(rows)) > i)).tolist():
            a, b = find(root[i]), find(root[j])
            if a != b:
                parent[a] = b
                out.append((node[i], node[j]))
    return pd.DataFrame(out, columns=["x", "y"], dtype=np.int64)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    A text's set has its distinct ``words``-word shingles of the lower-cased (A-Z) words;
    the whole sequence if it is shorter. A null, empty or blank text has none, is linked
    with nothing and kept. Rows with a null doc_id are returned with a null component and
    kept. Rows that repeat a doc_id count as one node. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = stored(signatures(docs, words), "signatures")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        full.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), *[F.first(k).alias(k) for k in ("n_shingles", "a", "b")]), "classes"
    )
    # The aggregate combines where keys are made and the join is split by Spark on a hot
    # key, so a group of any size is dealt to many tasks.
    keys = _table_keys(classes)
    low = keys.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("most")).where("x < most")
    members = stored(keys.join(low.select("key", "x"), "key"), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    sets = stored(shingle_sets(texts.join(members.select("node").distinct(), "node", "left_semi"), words), "sets")

    search = _Search(classes.select("node", F.col("n_shingles").alias("n")), sets)
    others = members.where("x < node")
    search.add(linked(others.select("x", F.col("node").alias("y")).distinct(), sets, percent))
    crowd = search.apart(others.select("key", "node")).select("node").distinct()
    rare = stored(_rare_keys(sets.join(crowd, "node", "left_semi"), percent), "rare-shingles")
    search.add(_family_links(search.families(rare), percent))

    label = (
        classes.select("d1", "d2", "node")
        .join(search.roots, "node", "left")
        .groupBy("d1", "d2")
        .agg(F.min(F.coalesce("root", "node")).alias("component_id"))
    )
    return (
        rows.select("doc_id", "n_shingles", "d1", "d2")
        .join(label, ["d1", "d2"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
