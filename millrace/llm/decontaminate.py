"""Benchmark decontamination by templates, in Spark expressions only.

Numbers, the units behind them and names become typed placeholders, so a question that
was given other figures or another name has the same template. Windows of WINDOW words
of the templates are joined by hash, and windows of the plain words as well, so that a
window of hardly anything but placeholders, or in another case, is found word for word. Matches of one item in one document on one diagonal
are one occurrence. Equal values of the item must stand for equal values of the document
in it: windows with a value that has several there do not count, unless they have the
item's own values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import is_small

from .frames import prepare, stored

WINDOW = 8
# Words of a window's template that must not be placeholders.
LITERALS = 3
# Items with fewer words only match a document that has no others.
SHORTEST = 5
# Share of an item's windows that a document must have, in percent.
COVERED = 50
# Or so many running words of it, however long the item is.
RUN = 13

# Units of measure.
UNITS = [
    "mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "t", "lb", "lbs", "oz", "ml", "cl", "l",
    "ms", "s", "sec", "min", "h", "hr", "hrs", "days", "weeks", "months", "years", "hours", "minutes", "seconds",
    "meters", "metres", "miles", "inches", "feet", "grams", "kilograms", "pounds", "litres", "liters",
    "dollars", "euros", "cents", "usd", "eur", "percent", "degrees", "w", "kw", "v", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb",
]

# The marks that a placeholder's value carries: number, name, unit.
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` with text as words without punctuation, a space between them; numbers, names and units keep their value behind a mark.

    A name is a capitalised word inside a sentence: after a word or a comma and white space.
    Units may be written in any case. A step goes over a text only if there is something in it for the step.
    """
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    text = F.col("text")
    steps = [
        (f"[{NUMBER}-{UNIT}]", F.translate(text, NUMBER + NAME + UNIT, "")),
        (r"[\s\p{Z}]{2}|[\s\p{Z}&&[^ ]]", F.regexp_replace(text, r"[\s\p{Z}]+", " ")),
        (r"[\p{L}\p{N},;] \p{Lu}\p{Ll}", F.regexp_replace(text, r"(?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", NAME + "$1")),
        (
            "[0-9]",
            F.regexp_replace(
                text, rf"(?<![\p{{L}}\p{{N}}{NUMBER}-{UNIT}])(\d+(?:[.,:/]\d+)*)(?: ?((?i:{units})))?(?![\p{{L}}\p{{N}}])", f"{NUMBER}$1 {UNIT}$2"
            ),
        ),
    ]
    # The commonest white space first, as a plain exchange of characters.
    rows = rows.withColumn("text", F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")))
    for needs, changed in steps:
        rows = rows.withColumn("text", F.when(text.rlike(needs), changed).otherwise(text))
    return rows.withColumn("text", F.regexp_replace("text", rf"[^\p{{L}}\p{{N}}\s{NUMBER}-{UNIT}]+", ""))


def tokens(text: Column) -> Column:
    """The words of a marked text."""
    return F.filter(F.split(text, " "), lambda t: (t != "") & (t != UNIT))


def _is_slot(token: Column) -> Column:
    return token < "\x04"


def _is_name(token: Column) -> Column:
    return F.left(token, F.lit(1)) == NAME


def _folded(text: Column) -> Column:
    """In lower case, by way of upper case, as for the German sharp s."""
    return F.lower(F.upper(text))


def _window_hashes(rows: DataFrame, sizes: list[int], key: str) -> DataFrame:
    """(key, h): the hashes alone of all windows of rows (key, text), texts marked: of plain words, and of both templates.

    It has every hash by which ``_windows`` could meet, so a text that shares none has no match.
    """
    text = F.col("text")
    rows = rows.select(key, _folded(text).alias("text")).select(key, "text", text.rlike(f"[{NUMBER}-{UNIT}]").alias("has"))
    plain = F.when(F.col("has"), F.translate("text", NUMBER + NAME + UNIT, "")).otherwise(text)
    rows = rows.select(
        key,
        F.transform(F.filter(F.split(plain, " "), lambda t: t != ""), lambda t: F.xxhash64(t)).alias("words"),
        F.when(F.col("has"), tokens(text)).alias("tokens"),
    )
    mark = lambda w, t, is_slot: F.when(is_slot, F.xxhash64(F.left(t, F.lit(1)))).otherwise(w)
    rows = rows.withColumns(
        {
            "named": F.zip_with("words", "tokens", lambda w, t: mark(w, t, _is_slot(t))),
            "figured": F.zip_with("words", "tokens", lambda w, t: mark(w, t, _is_slot(t) & ~_is_name(t))),
        }
    )
    count = F.size("words")
    # Outer, as Spark else tests the array for rows before it is made, which makes it twice.
    placed = rows.select(key, "words", "named", "figured", count.alias("count"), F.posexplode_outer("words").alias("at", "word"))

    def of(hashes: str) -> list[Column]:
        out = []
        for size in sizes:
            fits = F.col("at") + size <= F.col("count") if size >= SHORTEST else (F.col("at") == 0) & (F.col("count") == size)
            out.append(F.when(fits, F.xxhash64(F.lit(size), *[F.get(hashes, F.col("at") + k) for k in range(size)])))
        return out

    every = F.when(F.col("named").isNull(), F.array(*of("words"))).otherwise(F.array(*of("words"), *of("named"), *of("figured")))
    return placed.select(key, F.explode_outer(every).alias("h")).where("h is not null")


def _windows(rows: DataFrame, sizes: list[int], key: str, judged: bool = False) -> DataFrame:
    """(key, size, at, h, slots, rich): the windows of each size of rows (key, text), texts marked.

    Every window has a key of its plain words, with slots null. Those with enough other
    words have a key of their template, too, if they hold a name, and one in which names
    are words, if they hold a number: names are told by their case, which a copy may not
    have. If ``judged``, the key of plain words has in rich whether the window has enough
    words that are no placeholders.
    """
    rows = rows.select(key, _folded(F.col("text")).alias("text")).select(
        key,
        F.transform(tokens(F.translate("text", NUMBER + NAME + UNIT, "")), lambda t: F.xxhash64(t)).alias("words"),
        # Null for a text without placeholders, which most steps then skip.
        F.when(F.col("text").rlike(f"[{NUMBER}-{UNIT}]"), tokens(F.col("text"))).alias("tokens"),
    )
    rows = rows.select(
        key,
        "words",
        # Values behind their mark, null for a word.
        F.transform("tokens", lambda t: F.when(_is_slot(t), t)).alias("values"),
        F.filter(F.transform("tokens", lambda t, i: F.when(_is_slot(t), i + 1)), lambda i: i.isNotNull()).alias("marked"),
        F.filter(F.transform("tokens", lambda t, i: F.when(_is_name(t), i + 1)), lambda i: i.isNotNull()).alias("named"),
    )
    rows = rows.select(
        key,
        "words",
        "values",
        "marked",
        F.when(F.size("named") > 0, F.col("named")).alias("named"),
        F.when(F.size("marked") > F.size("named"), F.array_except("marked", "named")).alias("figured"),
    )
    rows = rows.withColumn("figures", F.when(F.col("figured").isNotNull(), F.transform("values", lambda v: F.when(~_is_name(v), v))))
    for places, values in (("named", "values"), ("figured", "figures")):
        hashes = F.zip_with("words", values, lambda w, v: F.when(v.isNull(), w).otherwise(F.xxhash64(F.left(v, F.lit(1)))))
        rows = rows.withColumn(f"template_{values}", F.when(F.col(places).isNotNull(), hashes))
    count = F.size("words")
    nothing = F.array().cast("array<struct<size: int, at: int, h: bigint, slots: array<string>, rich: boolean>>")

    def of(size: int) -> Column:
        last = count - size + 1
        fits = last >= 1 if size >= SHORTEST else last == 1

        def rich(i: Column) -> Column:
            # A short window is all there is of its text, so its words need no minimum.
            return F.lit(True) if size < SHORTEST else F.coalesce(F.size(F.filter("marked", lambda m: (m >= i) & (m < i + size))), F.lit(0)) <= size - LITERALS

        def made(places: Column, hashes: str, slots, rich) -> Column:
            windows = F.transform(
                places,
                lambda i: F.struct(
                    F.lit(size).alias("size"),
                    i.alias("at"),
                    F.xxhash64(F.slice(hashes, i, size)).alias("h"),
                    slots(i).alias("slots"),
                    rich(i).alias("rich"),
                ),
            )
            return F.coalesce(F.when(fits, windows), nothing)

        every = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))

        def over(places: str) -> Column:
            around = F.transform(places, lambda m: F.sequence(F.greatest(m - size + 1, F.lit(1)), F.greatest(F.least(m, last), F.lit(1))))
            return F.array_distinct(F.flatten(around))

        def filled(places: str, values: str) -> Column:
            slots = lambda i: F.filter(F.slice(values, i, size), lambda v: v.isNotNull())
            windows = made(over(places), f"template_{values}", slots, unknown)
            windows = F.filter(windows, lambda w: size - F.size(w["slots"]) >= LITERALS) if size >= SHORTEST else windows
            return F.when(F.col(places).isNotNull(), windows).otherwise(nothing)

        unknown = lambda i: F.lit(None).cast("boolean")
        plain = made(every, "words", lambda i: F.lit(None).cast("array<string>"), rich if judged else unknown)
        return F.concat(plain, filled("named", "values"), filled("figured", "figures"))

    return rows.select(key, F.explode(F.flatten(F.array(*map(of, sizes)))).alias("w")).select(key, "w.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, covered: int = COVERED) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows, is_copy for each document that has an item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. n_windows counts the
    item's windows (one, the whole, if it is shorter than WINDOW), n_matched those found in
    the document, by their template or word for word. At least ``covered`` percent must be,
    of all windows or of those that have a template or no placeholder, or the windows of RUN
    running words in one occurrence. is_copy tells whether
    each window found has the item's own values somewhere. Null and empty texts have no words
    and match nothing; rows with a null id are left out, as they cannot be named; repeated rows
    give one result; other columns are not read.

    All texts are reduced to the hashes of their windows first. Only documents that share one
    with an item are read again, for the values and places that the rules need.
    """
    spark = prepare(docs.sparkSession)
    items = (
        benchmark.where("item_id is not null")
        .select(F.col("item_id").cast("long"), "text")
        .transform(marked)
        .withColumn("length", F.least(F.size(tokens(F.col("text"))), F.lit(WINDOW)))
        .where("length > 0")
    )
    sizes = [r[0] for r in items.select("length").distinct().orderBy("length").collect()]  # WINDOW values at most
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, n_matched int, n_windows int, is_copy boolean")
    own = _windows(items.select("item_id", "text"), sizes, "item_id", judged=True).join(
        items.select("item_id", "length").distinct(), "item_id"
    ).where("size = length")
    own = stored(own.select("item_id", "size", F.col("at").alias("j"), "h", F.col("slots").alias("item_slots"), "rich"), "benchmark-windows")
    judged = own.where("rich is not null").groupBy("item_id", "j").agg(F.max("rich").alias("rich"))
    total = judged.groupBy("item_id").agg(F.count("j").alias("n_windows"), F.count_if("rich").alias("n_rich"))
    own = own.drop("rich").join(F.broadcast(judged) if is_small(judged) else judged, ["item_id", "j"])
    side = F.broadcast(own) if is_small(own) else own

    of_items = [_window_hashes(items.where(F.col("length") == size), [size], "item_id").select("h") for size in sizes]
    wanted = stored(reduce(DataFrame.union, of_items).distinct(), "benchmark-hashes")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    hashes = _window_hashes(marked(texts), sizes, "doc_id")
    near = stored(hashes.join(F.broadcast(wanted) if is_small(wanted) else wanted, "h", "left_semi").select("doc_id").distinct(), "candidates")
    texts = texts.join(F.broadcast(near) if is_small(near) else near, "doc_id", "left_semi")
    # Rows that repeat an id with another text are occurrences of their own.
    named = marked(texts.select(F.struct("doc_id", F.xxhash64("text").alias("d")).alias("doc"), "text"))
    found = _windows(named, sizes, "doc").drop("rich").join(side, ["h", "size"])
    none = F.array().cast("array<struct<a: string, b: string>>")
    pairs = F.when(
        F.size("slots") == F.size("item_slots"),
        F.transform(F.arrays_zip("item_slots", "slots"), lambda p: F.struct(p["item_slots"].alias("a"), p["slots"].alias("b"))),
    ).otherwise(none)
    # One occurrence has at most the item's windows, so its lists are bounded by the item.
    occurrence = (
        found.withColumn("pairs", F.coalesce(pairs, none))
        .groupBy("doc", "item_id", (F.col("at") - F.col("j")).alias("diagonal"))
        .agg(F.collect_set(F.struct("j", "rich", "pairs")).alias("js"))
        .withColumn("pairs", F.array_sort(F.array_distinct(F.flatten("js.pairs"))))
    )
    # The item's values that stand for several: in order, they follow each other.
    pair = lambda i: F.element_at("pairs", i)
    follows = F.when(F.size("pairs") > 1, F.filter(F.sequence(F.lit(1), F.size("pairs") - 1), lambda i: pair(i)["a"] == pair(i + 1)["a"]))
    torn = F.coalesce(F.transform(follows, lambda i: pair(i)["a"]), F.array().cast("array<string>"))
    consistent = occurrence.withColumn("torn", torn).withColumn(
        "js",
        F.transform(
            F.transform("js", lambda w: F.struct(w["j"].alias("j"), w["rich"].alias("rich"), F.forall(w["pairs"], lambda p: p["a"] == p["b"]).alias("same"), w["pairs"].alias("pairs"))),
            lambda w: F.struct(w["j"].alias("j"), w["rich"].alias("rich"), w["same"].alias("same"), (w["same"] | ~F.arrays_overlap(w["pairs"]["a"], "torn")).alias("whole")),
        ),
    )
    # The first and last of RUN - WINDOW + 1 windows in order lie as far apart as in an unbroken run.
    step = RUN - WINDOW
    place = lambda i: F.element_at("place", i)
    consistent = consistent.withColumn("place", F.array_sort(F.array_distinct(F.filter("js", lambda w: w["whole"])["j"]))).withColumn(
        "run", F.when(F.size("place") > step, F.exists(F.sequence(F.lit(1), F.size("place") - step), lambda i: place(i + step) - place(i) == step)).otherwise(False)
    )
    share = lambda part, whole: (F.col(part) >= 1) & (F.col(part) * 100 >= F.col(whole) * covered)
    return (
        consistent.select("doc.doc_id", "item_id", "run", F.explode("js").alias("at"))
        .select("doc_id", "item_id", "run", "at.*")
        .groupBy("doc_id", "item_id", "j")
        .agg(*(F.max(c).alias(c) for c in ("rich", "run", "same", "whole")))
        .groupBy("doc_id", "item_id")
        .agg(
            F.count_if("whole").cast("int").alias("n_matched"),
            F.count_if(F.col("whole") & F.col("rich")).alias("n_rich_matched"),
            F.min("same").alias("is_copy"),
            F.max("run").alias("run"),
        )
        .join(total, "item_id")
        .where(share("n_matched", "n_windows") | share("n_rich_matched", "n_rich") | F.col("run"))
        .select("doc_id", "item_id", "n_matched", F.col("n_windows").cast("int"), "is_copy")
    )
