"""The corpus operators against brute force, and on odd input."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.llm import ORACLE, QUERIES, arrays, decontaminate, frames, language, minhash, packing, pii, quality_model, quality_rules, sentence_dedup, suffix_dedup, toxicity
from millrace.llm.queries import RANKS, TOKENIZER
from oracle import difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ["ka", "lo", "mi", "ne", "ru", "ta", "so", "vi", "po", "de"]


def words(chance, n):
    return ["".join(chance.choices(SYLLABLES, k=chance.randint(1, 4))) for _ in range(n)]


def sentence(chance, n=9):
    return " ".join(words(chance, n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text): prose, exact and near copies, shared passages, repeats within a text."""
    chance = random.Random(7)
    texts = [" ".join(sentence(chance) for _ in range(chance.randint(1, 14))) for _ in range(60)]
    passage = " ".join(sentence(chance) for _ in range(7))
    for k in range(0, 60, 6):
        near = texts[k].split()
        near[chance.randrange(len(near))] = "otherword"
        texts += [texts[k], " ".join(near), texts[k + 1] + " " + passage, passage + " " + texts[k + 2]]
    texts += [passage * 3, "xy" * 400, "same words again " * 90, "É" * 130, "short", "two words", "THE CAPS " * 30]
    return list(enumerate(texts))


ODD = [
    (900, None), (901, ""), (902, " \n\t "), (None, "A row without an id, of more words than one."), (None, None),
    (903, "a"), (904, "It is a text. " * 4000), (905, "wörd\x00 with\x0bcontrol characters \U0001f600 and 𝒳"),
    (906, "the same row the same row the same row"), (906, "the same row the same row the same row"), (907, "<|endoftext|> is text"),
]

CLASHES = ["words", "key", "node", "n", "h", "d", "score", "length", "shard", "tokens", "lines", "windows", "root", "label", "size", "at", "body", "bins"]


def frame(spark, rows, odd=False):
    rows = [(i, t, "en", "s", len(t or ""), *[k] * len(CLASHES)) for k, (i, t) in enumerate(rows)]
    names = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} int" for c in CLASHES)
    return spark.createDataFrame(rows, names).repartition(5)


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).cache()


@pytest.fixture(scope="module")
def labels(spark, corpus):
    rows = [(i, int("word" not in t), int("otherword" in t)) for i, t in corpus] + [(None, 1, 1), (3, None, None), (5, 1, 0), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# -- 1 quality rules ---------------------------------------------------------------


def rules_by_hand(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
    lines, dup, before = text.split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in before
            before.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def test_quality_rules(spark, corpus, docs, odd):
    for rows, df in ((corpus, docs), (ODD, odd)):
        got = quality_rules.apply_rules(df).collect()
        found = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
        assert found == collections.Counter((i, *rules_by_hand(t)) for i, t in rows)
        assert all(not (r.base_failed and r.kept) for r in got)
    plan = quality_rules.apply_rules(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("RoundRobin", "") or "InMemory" in plan


@pytest.mark.parametrize("name", ORACLE)
def test_oracle(spark, con, folder, name):
    assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None


# -- 2 and 8: repeated strings and sentences ------------------------------------------


def bytes_by_hand(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest(), left)
    return out


@pytest.mark.parametrize("hot", [1, 3, 20_000])
def test_suffix_dedup(corpus, docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got} == bytes_by_hand(corpus)


def test_suffix_dedup_odd(odd):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(odd).collect())
    assert len(got) == len(ODD)
    want = bytes_by_hand([r for r in ODD if r[0] is not None])
    assert all(n == want[i][0] and gone == want[i][1] for i, n, gone in got if i)


def test_cover_order_sorts_suffixes():
    chance = np.random.default_rng(0)
    for _ in range(20):
        data = chance.integers(0, 3, chance.integers(1, 300)).astype(np.uint8)
        text, rank = data.tobytes(), suffix_dedup.cover_order(data, 100)
        order = sorted(range(len(text)), key=lambda i: rank[i])
        assert [text[i : i + 100] for i in order] == sorted(text[i : i + 100] for i in range(len(text)))


def pieces_by_hand(text):
    """(words, word index at which each piece begins, piece starts of spans), one window at a time."""
    found = list(re.finditer(rb"[^\x20\x09-\x0D]+", text))
    words = [m[0] for m in found]
    data, _ = arrays.join([text])
    order = arrays.Rolling(data).of(np.array([m.start() for m in found], int), np.array([m.end() for m in found], int)).tolist()

    def least(size):
        windows = [range(k, k + size) for k in range(len(words) - size + 1)]
        return {i for w in windows for i in w if order[i] == min(order[j] for j in w)}

    starts = {0} | least(sentence_dedup.START) if words else set()
    cuts = starts | least(sentence_dedup.CUT)
    for k in range(1, len(words)):
        if words[k - 1][-1:] in (b".", b"!", b"?") or b"\n" in text[found[k - 1].end() : found[k].start()]:
            cuts.add(k)
    return words, sorted(cuts), sorted(starts)


def spans_by_hand(text):
    """(first piece, end piece, words) of each span of one text."""
    words, cuts, starts = pieces_by_hand(text)
    edges, out = [*cuts, len(words)], []
    for start in starts:
        p = cuts.index(start)
        e = next((e for e in range(p + 3, len(cuts) + 1) if edges[e] - start >= 20), None)
        if e:
            out.append((p, e))
    if words and not out:
        out = [(0, len(cuts))]
    elif out and out[-1][1] < len(cuts):
        out.append((out[-1][0], len(cuts)))
    return len(cuts), [(p, e, tuple(words[edges[p] : edges[e]])) for p, e in out]


def sentences_by_hand(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        n, spans = spans_by_hand((t or "").encode())
        gone = [0] * n
        for p, e, run in spans:
            # A span and the one to the end of the text may start at one piece and be equal only to others.
            if seen.setdefault(run, (i, p, e)) != (i, p, e):
                gone[p:e] = [1] * (e - p)
        out[i] = (n, sum(gone))
    return out


def test_sentences():
    text = "One two. Three?! four\nfive  six... Ünd so 3.5 weiter".encode()
    words, cuts, _ = pieces_by_hand(text)
    edges = [*cuts, len(words)]
    assert [text[a:b].split() for a, b in sentence_dedup.sentences(text)] == [words[a:b] for a, b in zip(edges, edges[1:])]
    long = b" ".join(b"w%d" % k for k in range(200))
    parts = [long[a:b] for a, b in sentence_dedup.sentences(long)]
    assert len(parts) > 30 and b" ".join(parts) == long and max(len(p.split()) for p in parts) <= sentence_dedup.CUT
    inner = [long[8:][a:b] for a, b in sentence_dedup.sentences(long[8:])]
    assert inner[-20:] == parts[-20:]
    assert sentence_dedup.sentences(b"") == sentence_dedup.sentences(b" \n ") == []


def test_sentence_dedup(corpus, docs, odd):
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in sentence_dedup.remove_repeated_sentences(docs).collect()}
    want = sentences_by_hand(corpus)
    assert got == want and any(n for _, n in want.values())
    assert sentence_dedup.remove_repeated_sentences(odd).count() == len(ODD)
    assert sentence_dedup.remove_repeated_sentences(odd.limit(0)).count() == 0


def test_every_window_of_sentences_is_compared(spark):
    """Three sentences of 7 words that stand elsewhere, too, are found wherever they begin."""
    chance = random.Random(5)
    prose = lambda: " ".join(chance.choices([f"u{k}" for k in range(3000)], k=7)) + "."
    rows = []
    for k in range(0, 200, 2):
        passage = [prose() for _ in range(3)]
        rows += [(i, " ".join([*[prose() for _ in range(chance.randint(1, 4))], *passage, *[prose() for _ in range(chance.randint(1, 4))]])) for i in (k, k + 1)]
    hand, seen = {}, set()
    for i, text in rows:
        pieces = sentence_dedup.Sentences([text.encode()])
        edges, n = [*pieces.begins.tolist(), len(pieces.word)], len(pieces.begins)
        words, spans = text.split(), []
        for p in range(n):
            e = next((e for e in range(p + 3, n + 1) if edges[e] - edges[p] >= 20), None)
            spans += [(p, e)] if e else []
        if spans[-1][1] < n:
            spans.append((spans[-1][0], n))
        runs = [(p, e, tuple(words[edges[p] : edges[e]])) for p, e in spans]
        gone = {q for p, e, run in runs if run in seen for q in range(p, e)}
        seen |= {run for _, _, run in runs}
        hand[i] = (n, len(gone))
    docs = frame(spark, rows)
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in sentence_dedup.remove_repeated_sentences(docs, every=True).collect()}
    assert got == hand
    found = [k for k in range(1, 200, 2) if got[k][1]]
    some = {r.doc_id for r in sentence_dedup.remove_repeated_sentences(docs).where("n_removed > 0").collect()}
    assert len(found) > len(some) and some <= set(found)


def test_repeats_within_a_text_do_not_move(spark, corpus):
    """Only the first of a text's equal spans goes to the count and the join; ids may repeat or be null."""
    clauses = [f"Clause {k} of the terms is read aloud twice." for k in range(4)]
    twice = " ".join(clauses * 3 + ["And then it ends here."])
    rows = [(1, "Before it. " + twice), (2, twice), (2, twice), (3, twice + " More words."), (3, "Other words first. " + twice), (None, twice), (None, twice)]
    spans = sentence_dedup._spans(frame(spark, [*rows, *[(i + 10, t) for i, t in corpus]]).where("doc_id is not null").dropDuplicates(["doc_id", "text"]), True)
    assert spans.groupBy("h", "check", "doc_id", "d").count().where("count > 1").count() == 0

    def by_hand(rows):
        """Pieces that go from each row with an id; of one id, the smaller signed crc32 comes first, equal rows share a place."""
        seen, out = {}, []
        for i, d, text in sorted((i, (zlib.crc32(t.encode()) ^ 1 << 31) - (1 << 31), t) for i, t in rows if i is not None):
            pieces = sentence_dedup.Sentences([text.encode()], True)
            edges, words, gone = [*pieces.begins.tolist(), len(pieces.word)], WORD.findall(text), set()
            for p, k in sorted(zip(*(x.tolist() for x in pieces.spans()[1:3]), strict=True)):
                if seen.setdefault(tuple(words[edges[p] : edges[p + k]]), (i, d, p, k)) != (i, d, p, k):
                    gone |= set(range(p, p + k))
            out.append((i, len(edges) - 1, len(gone)))
        return sorted(out)

    every = lambda rows: [(r.doc_id, r.n_sentences, r.n_removed) for r in sentence_dedup.remove_repeated_sentences(frame(spark, rows), every=True).collect()]
    got = every(rows)
    assert sorted(r for r in got if r[0] is not None) == by_hand(rows) and [r[2] for r in got if r[0] is None] == [0, 0]
    assert 0 < by_hand(rows)[0][2] < by_hand(rows)[0][1]
    assert sorted(every(corpus)) == by_hand(corpus)


def test_sentence_dedup_leaves_no_shuffles(spark, docs):
    """The counts' shuffle is gone before the join writes its own, and the join's before the texts move."""

    def shuffles():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).rglob("shuffle_*")}

    before, seen = shuffles(), []
    write = frames.stored

    def watched(df, name, **how):
        out = write(df, name, **how)
        for _ in range(100):
            if not (left := shuffles() - before):
                break
            time.sleep(0.1)
        seen.append((name, len(left)))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sentence_dedup, "stored", watched)
        sentence_dedup.remove_repeated_sentences(docs, every=True)
    assert seen == [("spans-often", 0), ("repeated-spans", 0)]
    assert spark.conf.get(frames.CLEAN, "false") == "false"


@pytest.mark.parametrize("ends", ["", ".", "\n"])
def test_every_repeated_passage_loses_words(spark, ends):
    """51 words in other surroundings, from any word on, with full stops, line breaks or nothing; short copies."""
    chance = random.Random(3)
    vocabulary = [f"v{k}" for k in range(3000)]

    def prose(n):
        out = chance.choices(vocabulary, k=n)
        return [w + chance.choice(["", "", "", "", "", ends]) for w in out] if ends else out

    rows = []
    for k in range(0, 800, 2):
        passage = prose(51)
        rows += [(i, " ".join(prose(chance.randint(0, 60)) + passage + prose(chance.randint(0, 60)))) for i in (k, k + 1)]
    rows += [(1000, "Two sentences. Only."), (1001, "Two sentences. Only."), (1002, "one"), (1003, "one"), (1004, "other")]
    got = {r.doc_id: (r.n_removed, r.kept) for r in sentence_dedup.remove_repeated_sentences(frame(spark, rows)).collect()}
    assert not [k for k in range(0, 800, 2) if not got[k + 1][0]]
    assert not [k for k in range(0, 800, 2) if got[k][0]]
    assert [got[i][1].strip() for i in range(1000, 1005)] == [rows[800][1], "", "one", "", "other"]


# -- 5 near duplicates ----------------------------------------------------------------


def components_by_hand(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(corpus, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == components_by_hand(corpus)


def test_near_duplicates_in_crowded_keys(spark):
    """Many texts that share most of a passage; links only between some; families in several blocks."""
    chance = random.Random(3)
    base = words(chance, 60)
    rows = []
    for i in range(150):
        w = list(base)
        for k in chance.sample(range(60), chance.choice([1, 2, 3, 4, 6])):
            w[k] = words(chance, 1)[0]
        rows.append((i, " ".join(w)))
    size, minhash.BLOCK_SHINGLES = minhash.BLOCK_SHINGLES, 2000
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    finally:
        minhash.BLOCK_SHINGLES = size
    assert got == components_by_hand(rows)


def test_near_duplicates_odd(spark, odd):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.component_id == r.doc_id and r.kept for r in got)
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


# -- 9 decontamination ----------------------------------------------------------------


def test_templates(spark):
    item = "Anna has 12 apples and gives 5 kg of them to Peter while the others wait at home for dinner."
    copy = "Before it. " + item + " Behind it."
    other = item.replace("12", "31").replace("5 kg", "7 lb").replace("Peter", "Paul")
    twice = "Sum 3 apples and 3 pears in the old basket now"
    rows = [(1, copy), (2, other), (3, "Nothing of the kind is written here, only words that no item has at all."), (4, None), (5, ""), (None, copy), (1, copy)]
    rows += [(6, twice.replace("3", "4")), (7, "Sum 4 apples and 8 pears in the old basket now"), (8, "Blue sky"), (9, "A blue sky above")]
    items = spark.createDataFrame([(1, item), (2, twice), (3, "Blue sky"), (4, None), (5, ""), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.is_copy for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert got == {(1, 1): True, (2, 1): False, (6, 2): False, (8, 3): True}
    assert decontaminate.contaminated(frame(spark, rows), items.limit(0)).count() == 0
    assert decontaminate.contaminated(frame(spark, rows).limit(0), items).count() == 0


def test_items_of_placeholders_are_found_word_for_word(spark):
    table = "Year 1990 1991 1992 1993 1994 1995 1996 sums 17 28 39 41 52 63 74"
    items = spark.createDataFrame([(1, "Solve 3 x + 5 = 20"), (2, "What is 12 + 30 + 4"), (3, table), (4, "31 41 59 26 53 58 97 93 23 84")], "item_id long, text string")
    rows = [(1, "First: Solve 3 x + 5 = 20"), (2, "He asks: What is 12 + 30 + 4 in all"), (3, f"See {table} there"), (4, "digits 31 41 59 26 53 58 97 93 23 84")]
    rows += [(5, "Solve 4 x + 6 = 20"), (6, "digits 31 41 59 27 53 58 97 93 24 84"), (7, re.sub("[0-9]", "7", table))]
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows, r.is_copy) for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert got == {(1, 1): (1, 1, True), (2, 2): (1, 1, True), (3, 3): (9, 9, True), (4, 4): (3, 3, True)}


def test_case_and_white_space_hide_no_item(spark):
    item = "Gestern hat der Bauer Peter auf dem Markt in Berlin 12 Äpfel und 5 kg Birnen an die große Schule der Stadt verkauft."
    other = item.replace("12", "31").replace("5 kg", "7 g")
    rows = [(1, item.lower()), (2, item.upper()), (3, item.replace(" ", "\n  ")), (4, item.title()), (5, other.lower()), (6, other.upper())]
    rows += [(7, re.sub(" (?=[A-ZÄ])", "\u00a0\r\n", other.replace("Peter", "Paul"))), (8, "Morgen kauft die Schule keine Birnen auf dem Markt in Berlin und auch sonst nichts.")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.is_copy for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: False}


def test_a_passage_of_a_long_item_is_found(spark):
    chance = random.Random(3)
    w = words(chance, 500)
    far = words(chance, 40)
    items = spark.createDataFrame([(1, " ".join(w)), (2, "1 2 " + " ".join(far))], "item_id long, text string")
    rows = [(1, " ".join(w[100:300])), (2, "before it " + " ".join(w[480:493]) + " behind it"), (3, " ".join(w[480:492]) + " behind it")]
    rows += [(4, " ".join([*w[10:20], "else", *w[20:30], "else", *w[30:40]])), (5, " ".join(w))]
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows) for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert got == {(1, 1): (193, 493), (2, 1): (6, 493), (5, 1): (493, 493)}


def test_a_conflict_of_values_costs_its_windows_only(spark):
    sums = "A train that needs 12 minutes for a way of 5 km and a car on the road beside it meet at the bridge"
    twice = "There were 40 boats in the old harbour when the storm came and after a long night without any light all of the 40 boats had gone down with their crews"
    rows = [(1, sums.replace("12", "6").replace("5", "6")), (2, twice.replace("40 boats in", "44 boats in")), (3, twice), (4, twice.replace("40", "44"))]
    rows += [(5, twice), (5, twice.replace("40", "41")), (5, twice.replace("40", "42"))]
    items = spark.createDataFrame([(1, sums), (2, twice)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_windows, r.is_copy) for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    # Only the three windows over the edited number are lost.
    assert got == {(1, 1): (17, 17, False), (2, 2): (21, 24, False), (3, 2): (24, 24, True), (4, 2): (24, 24, False), (5, 2): (24, 24, True)}


def test_decontamination_by_hand(spark, folder):
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    plan = decontaminate.contaminated(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    plain = lambda t: re.sub(r"[^\w\s]", "", t or "").lower().split()
    windows = {}
    for r in items.collect():
        w = plain(r.text)
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), set()).add((r.item_id, k, len(w) - 7))
    want = set()
    for r in docs.collect():
        w, found = plain(r.text), collections.defaultdict(set)
        for k in range(len(w) - 7):
            for item, j, n in windows.get(tuple(w[k : k + 8]), ()):
                found[item, n].add(j)
        want |= {(r.doc_id, item) for (item, n), js in found.items() if 2 * len(js) >= n}
    assert want <= got and len(got) == len(want)


# -- 6 personal data ------------------------------------------------------------------


def test_base_spans():
    text = "mail a.b@c-d.org, ip 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111 or 4111111111111112, call +1 (974) 555-3436."
    assert [(k, text[a:b]) for k, a, b in pii.base_spans(text)] == [
        ("email", "a.b@c-d.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (974) 555-3436")
    ]


def test_messages_carry_a_label_to_a_distant_copy():
    """One occurrence is evidence, the other gets its label over the skip edge only."""
    text = "4111111111111111 " + "word " * 50 + "<4111-1111-1111-1111-x>"
    k = len(pii.LABELS)
    field = pii.Field(np.zeros((pii.DIM, k)), np.zeros((k, k)), 4 * np.eye(k))
    tokens = pii.Tokens("ab12cd99 " + "word " * 50 + "ab12cd99", [("card", 0, 8)])
    belief = field.marginals(tokens)
    assert tokens.skip.tolist() == [[0, 1]] and belief[1].argmax() == pii.LABELS.index("card") and belief[1].max() > 0.9
    assert pii.Field(field.unary, field.chain, 0 * field.skip).marginals(tokens)[1].max() < 0.5
    assert pii.base_spans(text)[0][0] == "card"


def test_messages_are_exact_on_a_chain():
    chance = np.random.default_rng(2)
    k = len(pii.LABELS)
    field = pii.Field(chance.normal(size=(pii.DIM, k)), chance.normal(size=(k, k)), np.zeros((k, k)))
    tokens = pii.Tokens("a1 b2 c3 d4", [])
    unary = field.unary[np.array(tokens.features)].sum(1)
    want = np.zeros((4, k))
    for y in itertools.product(range(k), repeat=4):
        p = np.exp(sum(unary[i, a] for i, a in enumerate(y)) + sum(field.chain[a, b] for a, b in zip(y, y[1:])))
        for i, a in enumerate(y):
            want[i, a] += p
    assert np.abs(field.marginals(tokens) - want / want.sum(1, keepdims=True)).max() < 1e-3


def test_personal_data(spark, odd):
    rows = [(i, f'Text {i} word. token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more, mail x{i}@mail.example.com, see 3.0 there.') for i in range(80)]
    got = pii.find_personal_data(frame(spark, rows)).collect()
    assert all(r.n_email == 1 and "secret:" in r.spans for r in got)
    base = {i: ",".join(f"{k}:{a}:{b}" for k, a, b in pii.base_spans(t)) for i, t in rows}
    assert all(r.base_sha256 == hashlib.sha256(base[r.doc_id].encode()).hexdigest() for r in got)
    clean = pii.redact(frame(spark, rows))
    assert clean.columns == frame(spark, rows).columns
    assert all("@" not in r.text and "<email>" in r.text and "<secret>" in r.text for r in clean.collect())
    assert pii.find_personal_data(odd).count() == len(ODD) == pii.redact(odd).count()
    assert pii.find_personal_data(odd.limit(0)).count() == 0


def planted(chance, k):
    """(text, kind, value) of what no pattern matches, in forms that the examples of the fit do not have, too."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda a, b, signs=letters: "".join(chance.choices(signs, k=chance.randint(a, b)))
    prose = lambda n: " ".join(word(2, 9) for _ in range(n))
    d = "".join(chance.choices("0123456789", k=10))
    name, secret, mixed = f"{word(3, 7)}_{word(3, 7)}{chance.randint(10, 99)}", word(10, 20), word(14, 24, letters + "0123456789")
    written = chance.choice([f"{word(3, 7)} dot {word(3, 7)} at {word(4, 7)} dot {word(2, 3)}", f"{word(3, 7)} [at] {word(4, 7)} [dot] {word(2, 3)}"])
    other = chance.choice([f"49{d}", f"0{d[:3]}-{d[3:6]}-{d[6:]}", f"({d[:3]}) {d[3:6]}.{d[6:]}", f"0{d}"])
    cases = [
        (f"{chance.choice(['Password', 'TOKEN', 'secret'])}{chance.choice([': ', '='])}{secret}", "secret", secret),
        (f"token: {mixed}", "secret", mixed),
        (written, "email", written),
        (f"+49 ({d[:3]}) {d[3:6]}-{d[6:]} {prose(30)}. Call {other}", "phone", other),
        (f"{name}@{word(4, 8)}.example.org {prose(30)} as {name}", "email", name),
    ]
    text, kind, value = cases[k % len(cases)]
    return f"{prose(20)}. {text} {prose(20)}.", kind, value


def test_recall_of_values_that_no_pattern_matches(spark, folder):
    chance = random.Random(11)
    rows = [planted(chance, k) for k in range(500)]
    clean = [
        (10_000 + k, ". ".join(sentence(chance) for _ in range(6)) + f" In {chance.randint(1900, 2030)} there were {chance.randint(1, 999)} of {k}.5 percent, key: value, look at this dot.")
        for k in range(500)
    ]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 100_000)
    extra = spark.createDataFrame([*enumerate(t for t, _, _ in rows), *clean], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs.union(extra)).where("doc_id < 100000").collect()}
    found = collections.Counter()
    for k, (text, kind, value) in enumerate(rows):
        at = text.rindex(value)
        spans = [s.split(":") for s in got[k].split(",") if s]
        found[k % 5] += any(s[0] == kind and int(s[1]) <= at and int(s[2]) >= at + len(value.rstrip(".")) for s in spans)
    assert min(found[k] for k in range(5)) >= 90, found
    assert sum(bool(got[i]) for i, _ in clean) <= 5


# -- 4, 7, 10: fitted models ------------------------------------------------------------


def held_out(i, n, r):
    return zlib.crc32(str(i).encode()) % n == r


def test_marginals_are_exact():
    chance = np.random.default_rng(1)
    sizes = np.array([0, 1, 2, 5, 7, 0, 4])
    bounds = np.r_[0, np.cumsum(sizes)]
    unary, pairs = 2 * chance.normal(size=bounds[-1]), chance.normal(size=(2, 2))
    size, toxicity.SEGMENT = toxicity.SEGMENT, 3
    try:
        got, _ = toxicity._forward_backward(unary, bounds, np.exp(pairs))
    finally:
        toxicity.SEGMENT = size
    for a, b in zip(bounds[:-1], bounds[1:]):
        want, total = np.zeros(b - a), 0
        for y in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(unary[a + i] * t for i, t in enumerate(y)) + sum(pairs[s, t] for s, t in zip(y, y[1:])))
            want, total = want + p * np.array(y), total + p
        assert np.allclose(got[a:b], want / total)


def agreement(spark, folder, name, label):
    got = QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    return got.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_held_out_accuracy(spark, folder):
    assert agreement(spark, folder, "op7_quality_classifier", "quality") > 0.97
    assert agreement(spark, folder, "op4_toxicity_crf", "toxic") > 0.93
    lang = QUERIES["op10_language_id"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert lang.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.99


def test_models_on_odd_input(spark, docs, odd, labels):
    for score, remainder, modulus in ((toxicity.score_toxicity, 0, 5), (quality_model.score_quality, 0, 5)):
        for known in (labels, labels.limit(0)):
            got = score(odd, known).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
            assert all(r.held_out == (r.doc_id is None or held_out(r.doc_id, modulus, remainder)) for r in got)
        assert score(odd.limit(0), labels).count() == 0
    got = language.predict_language(odd).collect()
    assert len(got) == len(ODD)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == dict.fromkeys((900, 901, 902), "und")
    assert {r.lang_pred for r in language.predict_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.predict_language(odd.limit(0)).count() == 0


def test_case_of_any_letter_hides_no_toxic_text(spark, folder):
    """Letters whose lower case has another length stay as they are and switch nothing off."""
    for text in ("ABC İẞK", "Straße ẞ", "ΑΣ", "𝒳yz", "", "É\x00Ü"):
        assert len(toxicity.folded(text)) == len(text.encode()) and toxicity.folded(text) == b"".join(toxicity.folded(c) for c in text)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    toxic = docs.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id").orderBy("doc_id").limit(40).collect()
    rows = []
    for r in toxic:
        rows += [(r.doc_id, r.text), (100_000 + r.doc_id, r.text.upper()), (200_000 + r.doc_id, r.text.upper() + " İ"), (300_000 + r.doc_id, "ẞ K " + r.text + " K")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs.union(extra.where("doc_id >= 100000")), labels).collect()}
    known = [r.doc_id for r in toxic if got[r.doc_id].predicted]
    assert len(known) > 30
    for shift in (100_000, 200_000, 300_000):
        assert [i for i in known if got[shift + i].predicted] == known
    # The spans are the words of the list that makes a text toxic, not all of it.
    spans = [got[i].spans for i in known]
    assert all(spans) and sum(s.end - s.start for x in spans for s in x) < 0.5 * sum(len(r.text) for r in toxic if r.doc_id in known)


def test_spans_are_code_points(spark):
    text = "éé bad wörd, fine"
    hot = (np.ones(2), np.array([5, 9]), np.array([8, 14]))
    assert [text[a:b] for a, b in toxicity._spans(text, hot)] == ["bad wörd"]


def test_rules_compile_to_what_was_fitted(spark):
    chance = np.random.default_rng(0)
    x = chance.random((400, len(quality_model.NAMES)))
    y = ((x[:, 0] > 0.5) & (x[:, 6] <= 0.4)).astype(float)
    bias, rules = quality_model.fit(x, y)
    want = bias + sum(w * quality_model._holds(r, x) for w, r in rules)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], quality_model.NAMES)
    got = [r[0] for r in df.select(quality_model.compiled(bias, rules)).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-want))) and ((np.array(got) > 0.5) == y).mean() > 0.95 and len(rules) < 60


# -- 3 packing --------------------------------------------------------------------------


def check_packing(rows, got, length=2048):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    return len(bins), -(-sum(r.length for r in got) // length)


def test_packing(spark, corpus, docs, odd):
    for rows, df in ((corpus, docs), (ODD, odd)):
        n, least = check_packing(rows, packing.pack(df, TOKENIZER, RANKS).collect())
        assert n <= least + 1
    assert packing.pack(odd.limit(0), TOKENIZER, RANKS).count() == 0


def test_packing_in_several_shards(spark, corpus, docs):
    whole, _ = check_packing(corpus, packing.pack(docs, TOKENIZER, None, 256).collect(), 256)
    size, packing.SHARD_PIECES = packing.SHARD_PIECES, 20
    try:
        n, _ = check_packing(corpus, packing.pack(docs, TOKENIZER, None, 256).collect(), 256)
    finally:
        packing.SHARD_PIECES = size
    assert n <= whole + 2


def test_genetic_packing_beats_best_fit():
    """Sizes in which best fit, largest first, wastes a bin; the operators keep every piece once."""
    sizes = np.array(sorted([44, 30, 26, 44, 30, 26, 51, 27, 22, 36, 34, 30, 36, 34, 30, 52, 48], reverse=True))
    plain = packing.best_fit(sizes, np.full(len(sizes), -1), 100)
    best = packing.evolve(sizes, [], 100, 1)[0]
    assert packing.fitness(sizes, best, 100) <= packing.fitness(sizes, plain, 100)
    chance = random.Random(1)
    for _ in range(50):
        child = packing.crossover(sizes, packing.mutated(sizes, plain, 100, chance), best, 100, chance)
        assert np.bincount(child, sizes).max() <= 100 and (child >= 0).all()


# -- the pipeline -----------------------------------------------------------------------


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in QUERIES["op7_quality_classifier"](spark, folder).where("predicted = 1").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        rows = {r.doc_id: r for r in docs.collect()} if k < 4 else docs.collect()
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            kept = {i: t for i, t in kept.items() if i in good}
            assert set(rows) == set(kept)
        if k == 1:
            roots = components_by_hand(list(kept.items())) if len(kept) < 2000 else None
            kept = {i: t for i, t in kept.items() if roots[i][1] == i}
            assert set(rows) == set(kept)
        if k == 2:
            gone = {r.doc_id for r in QUERIES["op9_benchmark_decontamination"](spark, folder).collect()}
            kept = {i: t for i, t in kept.items() if i not in gone}
            assert set(rows) == set(kept)
        if k == 3:
            assert set(rows) == set(kept)
            assert all(not pii.base_spans(r.text) or r.text != kept[i] for i, r in rows.items())
            assert all(r.text == kept[i] for i, r in rows.items() if not re.search("[0-9@]", kept[i]))
            kept = {i: r.text for i, r in rows.items()}
        if k == 4:
            n, least = check_packing(list(kept.items()), rows)
            assert n <= least + 1
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert "pipeline" in entry.queries()


def test_shingles_of_short_and_empty_texts():
    assert len(arrays.shingles(np.zeros(0, np.uint64), 5)) == 0
    assert len(arrays.shingles(np.arange(3, dtype=np.uint64), 5)) == 1


def test_every_stage_on_odd_rows_and_clashing_names(spark, folder, tmp_path_factory):
    """Null, empty, repeated and very long rows, names that the operators use themselves, and an empty table."""
    import corpus_pipeline

    home = str(tmp_path_factory.mktemp("sf"))
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{home}/{name}.parquet")
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    good = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(30).select("doc_id", "text").collect()
    rows = [*ODD, *map(tuple, good), *map(tuple, good[:5]), (2000, item), (None, item), (2001, "Long text. " * 30_000)]
    names = [*CLASHES, "__statistics", "row", "s", "gone", "has", "words.of", "h.x"]
    data = [(i, t, "en", "s", len(t or ""), *[k] * len(names)) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` int" for c in names)
    docs = spark.createDataFrame(data, schema).repartition(4)
    columns = docs.columns
    for df in (docs, docs.limit(0)):
        n = df.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, df, home)
            found = got.collect()
            assert k == 4 or got.columns == columns, name
            if k in (1, 2, 3):
                # Rows without an id or a text are nobody's copy and hold no item.
                assert sum(r.doc_id is None for r in found) == sum(i is None for i, _ in rows) * bool(n), name
                assert sum(r.doc_id in (900, 901, 902) for r in found) == 3 * bool(n), name
            if k == 2 and n:
                assert 2000 not in {r.doc_id for r in found} and n - 3 <= len(found) < n
            if k == 3:
                assert len(found) == n
            if k == 4 and n:
                check_packing(rows, found)
