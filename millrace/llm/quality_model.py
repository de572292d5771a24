"""Quality by a sparse ensemble of rules.

Statistics of each text are Spark columns. Boosted trees over a bounded sample of
labelled rows give rules: each path from a root is a conjunction of thresholds. A
lasso logistic regression weighs the rules, most of them with 0, and what is left is
compiled into one column expression, so scoring is a projection without Python.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import prepare, remainder, stored

# Labelled rows that the rules are fitted on, at most.
TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 32
LEAST_ROWS = 12
RATE = 0.2
PENALTY = 2e-3
THRESHOLD = 0.3

SYMBOLS = "#*$%&|<>"
MARKS = "!?.,;:"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
DIGITS = "0123456789"


def _without(text: Column, characters: str) -> Column:
    """Characters of ``text`` that are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.when(whole > 0, whole), F.lit(0.0)).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of one text by name; a null text is like an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    n_words, n_lines, n_chars = F.size(words), F.size(lines), F.length(text)
    return {
        "words": n_words.cast("double"),
        "word_length": _ratio(n_chars, n_words),
        "distinct_words": _ratio(F.size(F.array_distinct(words)), n_words),
        # The same over the logarithm of the length, which long texts need.
        "distinct_by_log": _ratio(F.size(F.array_distinct(words)) * F.log2(n_words + 1.0), n_words),
        "words_in_line": _ratio(n_words, n_lines),
        "distinct_lines": _ratio(F.size(F.array_distinct(lines)), n_lines),
        "symbols": _ratio(_without(text, SYMBOLS), n_chars),
        "marks": _ratio(_without(text, MARKS), n_chars),
        "exclamations": _ratio(_without(text, "!"), n_chars),
        "upper": _ratio(_without(text, UPPER), n_chars),
        "digits": _ratio(_without(text, DIGITS), n_chars),
        "bars": _ratio(_without(text, "|"), n_words),
    }


NAMES = [
    "words", "word_length", "distinct_words", "distinct_by_log", "words_in_line", "distinct_lines",
    "symbols", "marks", "exclamations", "upper", "digits", "bars",
]

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most?, threshold)


def _split(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int, float]:
    """The best (gain, statistic, threshold) of one node."""
    best = (1e-6, -1, 0.0)
    total, mass = gradient.sum(), weight.sum()
    for k, at in enumerate(cuts):
        place = np.searchsorted(at, x[:, k])  # x <= at[j] is place <= j
        g = np.bincount(place, gradient, len(at) + 1).cumsum()[:-1]
        h = np.bincount(place, weight, len(at) + 1).cumsum()[:-1]
        n = np.bincount(place, minlength=len(at) + 1).cumsum()[:-1]
        gain = g**2 / (h + 1) + (total - g) ** 2 / (mass - h + 1) - total**2 / (mass + 1)
        gain[(n < LEAST_ROWS) | (len(x) - n < LEAST_ROWS)] = 0
        if len(gain) and gain.max() > best[0]:
            best = (float(gain.max()), k, float(at[int(gain.argmax())]))
    return best


def rules_of_trees(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of TREES boosted trees of DEPTH levels."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, BINS))) for k in range(x.shape[1])]
    score = np.zeros(len(y))
    found: dict[Rule, None] = {}
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        # Each tree leaves out every fourth row in turn.
        used = np.arange(len(y)) % 4 != tree % 4
        nodes = [((), np.ones(len(y), bool))]
        for level in range(DEPTH + 1):
            below = []
            for rule, inside in nodes:
                fit = inside & used
                gain, k, at = _split(x[fit], cuts, gradient[fit], weight[fit]) if level < DEPTH and fit.sum() >= 2 * LEAST_ROWS else (0, -1, 0)
                if rule:
                    found[tuple(sorted(rule))] = None
                if k < 0:
                    score[inside] += RATE * gradient[fit].sum() / (weight[fit].sum() + 1)
                    continue
                low = x[:, k] <= at
                below += [((*rule, (k, True, at)), inside & low), ((*rule, (k, False, at)), inside & ~low)]
            nodes = below
    return list(found)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, at_most, at in rule:
        out &= (x[:, k] <= at) == at_most
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1 logistic regression, by accelerated proximal gradient."""
    rate = 4.0 / max(1.0, np.linalg.norm(np.c_[np.ones(len(z)), z] / np.sqrt(len(z)), 2) ** 2)
    w = v = np.zeros(z.shape[1] + 1)
    full = np.c_[np.ones(len(z)), z]
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(full @ v)))
        new = v - rate * (full.T @ (p - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[float, Rule]]]:
    """Intercept and weighted rules."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return float(np.log(rate / (1 - rate))), []
    rules = rules_of_trees(x, y)
    bias, weights = lasso(np.stack([_holds(r, x) for r in rules], 1).astype(float), y) if rules else (0.0, np.zeros(0))
    return bias, [(float(w), r) for w, r in zip(weights, rules, strict=True) if abs(w) > 1e-6]


def compiled(bias: float, rules: list[tuple[float, Rule]], prefix: str = "") -> Column:
    """The score as one expression over the statistics' columns, whose names begin with ``prefix``."""
    total = F.lit(bias)
    for weight, rule in rules:
        holds = F.lit(True)
        for k, at_most, at in rule:
            value = F.col(prefix + NAMES[k])
            holds = holds & ((value <= at) if at_most else (value > at))
        total = total + F.when(holds, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def train(stats: DataFrame, labels: DataFrame, name: str = "quality") -> tuple[float, list[tuple[float, Rule]]]:
    """Fit on at most about TRAIN_ROWS labelled rows, chosen by hash; ids with crc32 0 modulo 5 are left out.

    A row whose label is null is left out; of several labels for one id the largest counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
        .groupBy(F.col("doc_id").cast("long"))
        .agg(F.max(name).cast("double").alias("label"))
    )
    n = known.count()
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(min(1.0, TRAIN_ROWS / max(n, 1)) * 1_000_000))
    # At most about TRAIN_ROWS ids, whatever the input.
    rows = stats.join(F.broadcast(known), "doc_id").select("doc_id", "label", *NAMES).orderBy(F.xxhash64("doc_id"), *NAMES).collect()
    data = np.array([r[1:] for r in rows], float).reshape(len(rows), len(NAMES) + 1)
    return fit(data[:, 1:], data[:, 0])


def _statistics(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), *[c.alias(k) for k, c in statistics(F.col("text")).items()])


def _stored_statistics(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return stored(_statistics(docs), "statistics")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted to be good; read in place, without a shuffle.

    Statistics are made of the labelled rows for the fit, then once of all. Columns may have any name.
    """
    prepare(docs.sparkSession)
    score = compiled(*train(_statistics(docs), labels), prefix="s.")
    measured = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(*[c.alias(k) for k, c in statistics(F.col("text")).items()]).alias("s")
    )
    return measured.where(score >= THRESHOLD).select("row.*")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistics for each row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and quality. A null or empty text is scored like an empty one.
    A null doc_id is held out. Without labels of both kinds every row gets the same
    score. Repeated rows are scored alike. Other columns are not read.
    """
    stats = _stored_statistics(docs)
    score = compiled(*train(stats, labels))
    return (
        stats.withColumn("score", score)
        .select(
            "doc_id",
            F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            *NAMES,
        )
    )
