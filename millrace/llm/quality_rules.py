"""Quality rules: a table of thresholds, compiled into one projection.

Everything is a Spark expression over the text of one row. Each rule compares two whole
numbers, ``left * scale <= limit * right`` or the reverse, so there is no rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

# Frequent short words of the four languages of the corpus.
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "with", "this", "be", "on", "are", "by", "from", "or", "an", "at", "as", "he",
    "der", "die", "das", "und", "ist", "nicht", "mit", "für", "auf", "den", "dem", "von", "als", "im", "in", "zu", "ein", "eine", "sich", "auch",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "dans", "pour", "que", "qui", "sur", "avec", "par", "du", "en", "pas", "au", "il",
    "el", "los", "las", "y", "que", "se", "por", "con", "para", "una", "del", "no", "su", "lo", "es",
]

# (rule, what, whole, at least?, percent of the whole): what a text must not miss.
RULES = [
    ("few_symbols", "n_symbols", "word_chars", False, 5),
    ("not_shouted", "n_exclaimed", "n_words", False, 30),
    ("few_bars", "n_bars", "n_words", False, 30),
    ("few_repeated_lines", "n_dup_lines", "n_lines", False, 30),
    ("stop_words", "n_stop_words", "n_words", True, 1),
    ("short_words", "word_chars", "n_words", False, 1500),
]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def _windows(words: Column) -> Column:
    """(hash, place) of every window of WINDOW words, in order of the hash."""
    places = F.sequence(F.lit(1), F.size(words) - WINDOW + 1)
    hashed = F.transform(places, lambda i: F.struct(F.xxhash64(F.slice(words, i, WINDOW)).alias("h"), i.alias("i")))
    return F.sort_array(F.when(F.size(words) > WINDOW, hashed).otherwise(F.array().cast("array<struct<h: bigint, i: int>>")))


def _repeat_words(windows: Column) -> Column:
    """Words that lie in a window found more than once.

    A window beside an equal one is repeated. Their places in order, each covers as many
    new words as it is away from the one before, WINDOW at most.
    """
    again = F.filter(
        windows,
        lambda x, k: F.coalesce(F.get(windows, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(windows, k + 1)["h"] == x["h"], F.lit(False)),
    )
    return F.aggregate(
        F.sort_array(F.transform(again, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(1 - WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(i - a["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )


def _among(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(text: Column, words: Column, lines: Column, windows: Column) -> dict[str, Column]:
    """What the rules compare, by name, for a text, its words, its lines with a word and its windows."""
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": _among(text, SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(windows),
        "n_lines": F.size(lines),
        "n_exclaimed": F.size(F.filter(words, lambda w: w.endswith("!!"))),
        "n_bars": _among(text, "|"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
    }


def apply_rules(docs: DataFrame, rules: list[tuple[str, str, str, bool, int]] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed, failed (names of the failed rules) and kept for each row.

    ``docs`` has doc_id and text. A null text has no words, lines or characters, so it
    fails for its length, like an empty one. A rule over an empty whole holds. A null
    doc_id is returned as it is; repeated rows get the same answer; other columns are
    not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    parts = (
        docs.select(F.col("doc_id").cast("long"), text.alias("text"))
        .withColumns({"words": _words(F.col("text")), "lines": lines})
        .withColumn("windows", _windows(F.col("words")))
    )
    measured = measures(*[F.col(k) for k in ("text", "words", "lines", "windows")])
    counted = parts.select("doc_id", *[c.cast("long").alias(k) for k, c in measured.items()])
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    failed = [
        F.when((100 * F.col(what) < percent * F.col(whole)) if at_least else (100 * F.col(what) > percent * F.col(whole)), F.lit(name))
        for name, what, whole, at_least, percent in rules
    ]
    return (
        counted.withColumn("base_failed", base_failed)
        .withColumn("failed", F.filter(F.array(*failed), lambda x: x.isNotNull()))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )


def oracle(documents: str = "documents") -> str:
    """The same in DuckDB."""
    spaces, symbols = "[\\x20\\x09-\\x0D]", "[#*$%&|<>]"
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    failed = " OR ".join(f"100 * {a} {'<' if least else '>'} {p} * {b}" for _, a, b, least, p in RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{spaces}+', '', 'g') <> '') AS l
           FROM {documents}),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
      FROM d, LATERAL (SELECT unnest(range(1, len(w) - {WINDOW - 2})) AS i) WHERE len(w) >= {WINDOW}),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
k AS (SELECT doc_id, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{spaces}+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '{symbols}', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(k.n, 0)::BIGINT AS n_repeat_words,
             len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: x LIKE '%!!'))::BIGINT AS n_exclaimed,
             (length(t) - length(replace(t, '|', '')))::BIGINT AS n_bars,
             len(list_filter(w, lambda x: lower(x) IN ({stops})))::BIGINT AS n_stop_words
      FROM d LEFT JOIN k USING (doc_id)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({failed}) AS kept FROM f"""
