"""The Jaccard join and the spelling variants against brute force, and on odd input."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ORACLE, QUERIES, jaccard_join, spelling

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = ["key", "node", "n", "m", "most", "tag", "others", "word", "run", "h", "id", "at", "who", "form", "root", "x", "y"]


def frame(spark, rows):
    rows = [(i, t, *[k] * len(CLASHES)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {c} int" for c in CLASHES)).repartition(5)


# -- Jaccard join -------------------------------------------------------------------


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(CAPITALS))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components(rows, percent=85):
    """doc_id -> (size of its set, smallest document reached), from all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    low = {i: i for i, _ in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            low[y] = x
    return {(i, len(s), find(i)) for i, s in sets}


def near_copies(chance):
    """Texts of 1 to 400 words with copies from far to near, chains, and passages that many share."""
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [chance.choices(vocabulary, k=n) for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 50, 80, 120, 200, 400]]
    passage = chance.choices(vocabulary, k=60)
    for text in list(texts):
        for changes in (0, 1, 1, 2, 3, 5, 8):
            other = list(text)
            for _ in range(changes):
                at = chance.randrange(len(other) + 1)
                other[at : at + chance.choice([0, 1])] = chance.choices(vocabulary, k=chance.choice([0, 1, 1]))
            texts.append(other)
    for _ in range(40):  # each changes one word of the one before
        other = list(texts[-1]) or ["w"]
        other[chance.randrange(len(other))] = "changed"
        texts.append(other)
    texts += [passage + chance.choices(vocabulary, k=chance.randint(5, 40)) for _ in range(40)]
    texts = [" ".join(t) for t in texts]
    return list(enumerate(texts + [texts[20].upper(), texts[21].replace(" ", "\n \t"), texts[5]]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join_against_all_pairs(spark, seed):
    rows = near_copies(random.Random(seed))
    found = {tuple(r) for r in jaccard_join.join(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()}
    assert found == components(rows)


def test_pigeonhole_offers_hold_for_every_close_pair():
    """Whatever H + 1 offers the larger set takes, one of them leads to the smaller set."""
    chance = random.Random(5)
    for size in [7, 8, 13, 27, 40, 61, 90, 140, 300, 700]:
        for _ in range(20):
            s = np.array([chance.getrandbits(64) for _ in range(size)], np.uint64)
            h = jaccard_join.apart(size, 85)
            gone = chance.randint(0, h)
            t = np.concatenate([s[: size - gone], np.array([chance.getrandbits(64) for _ in range(chance.randint(0, (h - gone)))], np.uint64)])
            if len(t) > size or 100 * len(set(s) & set(t)) < 85 * len(set(s) | set(t)):
                continue
            (keys, tags), (others, _) = jaccard_join._keys(np.unique(s), 85), jaccard_join._keys(np.unique(t), 85)
            offers, others = collections.defaultdict(set), set(others.tolist())
            for key, tag in zip(keys.tolist(), tags.tolist(), strict=True):
                if tag & 1:
                    offers[tag >> 2, 1] |= {key} if tag >> 2 < jaccard_join.band(size, 85)[1] // jaccard_join.NEIGHBOURS else set()
                    offers[tag >> 2, 0] |= set() if tag & 2 else {key}
            failed = sum(bool(keys) and not keys & others for keys in offers.values())
            assert failed <= len(set(s.tolist()) ^ set(t.tolist())) <= h < sum(map(bool, offers.values()))


def test_jaccard_join_on_odd_rows(spark):
    long = " ".join(f"w{k * k % 9973}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b c"), (7, long), (8, long + " more"), (9, "x " * 5000), (10, "x x x x"), (11, "É é é é é"), (12, "é é é é é")]
    rows += [(20, "one two three four five six seven")] * 3
    wanted = components([*rows[:-2]])
    result = jaccard_join.join(frame(spark, [*rows, (None, "a b c"), (None, None)]))
    found = [tuple(r) for r in result.select("doc_id", "n_shingles", "component_id").collect()]
    assert {r for r in found if r[0] is not None} == wanted
    assert sorted(r for r in found if r[0] is None) == [(None, 0, None), (None, 1, None)] and len(found) == len(rows) + 2
    assert jaccard_join.join(frame(spark, rows).where("false")).count() == 0


def test_rows_that_repeat_an_id_are_one_node(spark):
    chance = random.Random(4)
    a, b = (" ".join(chance.choices([f"w{k}" for k in range(90)], k=60)) for _ in range(2))
    rows = [(5, a), (5, b), (7, a + " end"), (9, b + " end"), (3, "other words than those of the others")]
    found = {(r.doc_id, r.component_id) for r in jaccard_join.join(frame(spark, rows)).collect()}
    assert found == {(5, 5), (7, 5), (9, 5), (3, 3)}


# -- spelling variants ----------------------------------------------------------------


def counted(rows):
    words = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows):
    words = counted(rows)
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def misspelt(chance, documents):
    stems = ["spelling", "committee", "aaaaaaaa", "zzzyyyxxx", "straße", "ÀÉÎÕÜß", "missing", "mississippi", "banana", "bananas", "bananan"]
    for doc_id in range(documents):
        words = []
        for _ in range(120):
            word = chance.choice(stems[: chance.randint(1, len(stems))])
            for _ in range(chance.choice([0] * 12 + [1, 1, 2, 3])):
                at = chance.randrange(len(word) + 1)
                word = word[:at] + chance.choice(["", "a", "s", "é"]) + word[at + chance.choice([0, 1]) :]
            words.append(chance.choice([word, word, word.upper(), word.title()]))
        yield doc_id, chance.choice([" ", "-", ", ", "1"]).join(words)
    # A form that is itself the variant of another.
    yield 1000, "steppen " * 6 + "steppens " * 40 + "steppensx " * 300


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_variants_against_all_pairs(spark, seed):
    rows = list(misspelt(random.Random(seed), 60))
    found = [tuple(r) for r in spelling.variants(frame(spark, rows)).select(*COLUMNS).collect()]
    wanted = variants(rows)
    assert len(found) == len(wanted) and set(found) == wanted
    assert any(r[1] for r in wanted) and any(r[2] not in (r[0], r[1]) for r in wanted)


def test_spelling_variants_on_odd_rows(spark):
    run = "qwertz" * 20_000
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "Nobody nobody NOBODY nobody nobody nobodi"), (None, None), (4, f"{run} {run[:-1]} " * 5), (5, "𝒳yzzyx𝒳yzzyxa " * 6), (6, "×÷×÷×÷ " * 6)]
    rows += [(7, "repeated rows count")] * 5
    found = [tuple(r) for r in spelling.variants(frame(spark, rows)).select(*COLUMNS).collect()]
    assert set(found) == variants(rows) and len(found) == len(set(found))
    assert spelling.variants(frame(spark, rows).where("false")).count() == 0


def test_pairs_of_nodes_are_no_more_than_letters(spark):
    """Each word writes one pair for each letter and each gap, however often it occurs."""
    words = spark.createDataFrame([("banana", 9, 0), ("aaaaaa", 5, 1)], "word string, n long, id long")
    pairs = words.select("word", "id").mapInPandas(spelling._pairs, "p long, s long, id long, at int, gap boolean")
    assert {tuple(r) for r in pairs.groupBy("id", "gap").agg(F.count("*")).collect()} == {(k, gap, 6 + gap) for k in (0, 1) for gap in (False, True)}


@pytest.mark.parametrize("name", ["op12_ngram_jaccard_join", "op13_spelling_variants"])
def test_registered_queries_equal_their_sql(spark, con, folder, name):
    from oracle import difference

    assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None
