"""Spelling variants by a dictionary of pairs of trie nodes.

Words are written into two tries, one read forward and one from the end. A node's number
is a 64-bit hash of the letters on its path, so every task gives it the same and no table
of nodes is shuffled. A word writes the integer pair (prefix node, suffix node) around each
of its letters, which it skips there, and around each gap between letters.

* Two words that skip a letter between the same nodes differ by one replaced letter.
* A word with a gap between the nodes where another skips a letter lacks that letter.

A pair of nodes has at most one skipping word for each letter and one with a gap, so no
group is larger than the alphabet whatever the corpus. The words that share a pair are
compared letter by letter before they count, so an equal number of two nodes adds none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup_join
from millrace.session import configure

from . import arrays
from .frames import prepare, stored

LETTERS = "a-zÀ-ÿ"
MIN_LETTERS = 6
MIN_OCCURRENCES = 5
DAMAGED = 199
# How much commoner a form is than its variant.
COMMONER = 5


def damaged_words(docs: DataFrame) -> DataFrame:
    """(word, n): the runs of letters of all texts after the damage of the contract."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    runs = docs.select(name, F.explode(F.split(lowered, f"[^{LETTERS}]+")).alias("run"))
    # A shorter run does not become a word.
    runs = runs.where(F.length("run") >= MIN_LETTERS).withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count("*").alias("n"))


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(p, s, id, at, gap): the nodes around each letter, and around each gap."""
    for batch in batches:
        # Letters up to U+00FF: one byte each.
        values, ids = [w.encode("latin-1") for w in batch["word"]], batch["id"].to_numpy()
        for a, b in arrays.chunks(values):
            size = np.array([len(v) for v in values[a:b]])
            first = np.cumsum(size) - size
            rolling = arrays.Rolling(np.frombuffer(b"".join(values[a:b]), np.uint8))
            for gap in (False, True):
                count = size + gap
                word = np.repeat(np.arange(b - a), count)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start, here = first[word], first[word] + at
                p = rolling.of(start, here)
                s = rolling.of(here + (not gap), start + size[word])
                yield pd.DataFrame({"p": arrays.signed(p), "s": arrays.signed(s), "id": ids[a:b][word], "at": at, "gap": gap})


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best (struct of -n and word) of the words (word, n, id) that have a near word."""
    pairs = words.select("word", "id").mapInPandas(_pairs, "p long, s long, id long, at int, gap boolean")
    shared = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("id", "at", "gap")).alias("who")).where(F.size("who") > 1)
    met = lookup_join(shared.select(F.explode("who").alias("w")).select("w.*"), words, "id", "inner")
    # What is left of the word around the letter or gap, exactly.
    head = F.substring("word", F.lit(1), F.col("at"))
    tail = F.substring("word", F.col("at") + F.when(F.col("gap"), 1).otherwise(2), F.length("word"))
    # A letter of a run of equal letters leaves the same word wherever it is taken: the first counts.
    letter = lambda shift: F.substring("word", F.col("at") + shift, F.lit(1))
    first = F.col("gap") | (F.col("at") == 0) | (letter(1) != letter(0))
    who = F.struct((-F.col("n")).alias("less"), "word", "gap", first.alias("first"))
    groups = met.groupBy(head.alias("head"), tail.alias("tail")).agg(F.sort_array(F.collect_list(who)).alias("who")).where(F.size("who") > 1)

    def near(own):
        def other(w):
            return (w["word"] != own["word"]) & ((~own["gap"] & ~w["gap"]) | ((own["gap"] | w["gap"]) & own["first"] & w["first"]))

        found = F.filter("who", other)
        best = F.get(found, F.lit(0))
        return F.struct(own["word"].alias("word"), F.size(found).alias("n_near"), F.struct(best["less"].alias("less"), best["word"].alias("word")).alias("best"))

    each = groups.select(F.explode(F.transform("who", near)).alias("w")).select("w.*").where("n_near > 0")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the forms (word, form) lead to.

    A form is several times as common as its variant, so there is no cycle; each round
    doubles the steps, so rounds grow with the logarithm of the longest way.
    """
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("last"))
        moved = Observation()
        joined = lookup_join(found, further, "root").observe(moved, F.count("last").alias("n"))
        found = stored(joined.select("word", F.coalesce("last", "root").alias("root")), "roots")
        if not moved.get["n"]:
            return found


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of all texts of ``docs`` (doc_id, text).

    Runs, damage, words, near words and forms are those of the contract. A null, empty or
    letterless text has no words; a null doc_id counts as an empty one in the damage; rows
    that repeat count each time. Other columns are ignored; an empty table gives no word.
    """
    prepare(configure(docs.sparkSession))
    counted = damaged_words(docs).where(F.col("n") >= MIN_OCCURRENCES)
    words = stored(counted.withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(words).select("word", "n_near", F.col("best.word").alias("near"), (-F.col("best.less")).alias("near_n"))
    named = lookup_join(words.drop("id"), near, "word")
    form = F.col("near_n") >= COMMONER * F.col("n")
    named = stored(
        named.select(
            "word",
            F.when(form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(named.where("form is not null"))
    return lookup_join(named, last, "word").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle() -> str:
    """The same in DuckDB's SQL: near words meet in a pattern with the letter left out or inserted."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    for _ in range(7):
        step = f"list_transform([{step}], lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)[1]"
    return rf"""
WITH RECURSIVE bytes AS (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_transform([i::UBIGINT], lambda c: {step})[1] AS c FROM range(256) r(i))),
occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{LETTERS}]+')) AS run FROM documents
),
runs AS (SELECT doc_id, run, count(*) AS times, coalesce(doc_id::VARCHAR, '') || ':' || run AS named FROM occurrences WHERE length(run) >= {MIN_LETTERS} GROUP BY ALL),
coded AS (
  SELECT *, flatten(list_transform(string_split(named, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS code
  FROM runs
),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::UBIGINT, code::UBIGINT[]), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) AS h
  FROM coded, bytes
),
damaged AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed
),
words AS (SELECT word, sum(times)::BIGINT AS n FROM damaged WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(times) >= {MIN_OCCURRENCES}),
skips AS (SELECT word, n, i, left(word, i) || '*' || substring(word, i + 2) AS pattern FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
gaps AS (SELECT word, n, left(word, i) || '*' || substring(word, i + 1) AS pattern FROM (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM skips a JOIN skips b USING (pattern) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM skips a JOIN gaps b USING (pattern)
  UNION SELECT b.word, a.word, a.n FROM skips a JOIN gaps b USING (pattern)
),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.most >= {COMMONER} * w.n THEN b.most END AS form_n,
    CASE WHEN b.most >= {COMMONER} * w.n THEN (SELECT min(near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.most) END AS form
  FROM words w LEFT JOIN best b USING (word)
),
ways AS (
  SELECT word, word AS last, 0 AS steps FROM forms
  UNION ALL SELECT ways.word, forms.form, steps + 1 FROM ways JOIN forms ON forms.word = ways.last WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, (SELECT arg_max(last, steps) FROM ways WHERE ways.word = f.word) AS root, f.n, f.n_near, f.form_n FROM forms f
"""
