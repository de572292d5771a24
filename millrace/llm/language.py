"""Language by multinomial logistic regression on TF-IDF of character n-grams.

Each text is counted into DIM hashed n-grams of one to three characters. Document
frequencies come from all texts that may be learned from. The weights are fitted on at
most TRAIN_DOCS of them, the same share for each language, by follow-the-regularised-
leader: L1 keeps the weights sparse, L2 small. Another CALIBRATION_DOCS at most set a
temperature, so that the score is a probability. Scoring reads each row once, in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .frames import prepare, remainder

DIM = 1 << 15
TRAIN_DOCS = 4000
CALIBRATION_DOCS = 1000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-4
UNKNOWN = "und"
# Characters that are counted at a time; a text of any length needs no more memory.
PIECE = 1 << 20


def counts(text: str | None) -> np.ndarray:
    """How often each hashed n-gram occurs in the lower-cased text."""
    out = np.zeros(DIM, np.int64)
    text = (text or "").lower()
    for at in range(0, len(text), PIECE):
        code = np.frombuffer(text[max(0, at - 2) : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if at == 0:  # three spaces begin a text, so each character ends one n-gram of each size
            code = np.concatenate([[np.uint64(32), np.uint64(32)], code])
        gram = np.zeros(len(code) - 2, np.uint64)
        for size in range(3):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + code[2 - size : len(code) - size] + np.uint64(1)
            out += np.bincount((gram * np.uint64(0xBF58476D1CE4E5B9 + 2 * size) >> np.uint64(64 - 15)).astype(np.int64), minlength=DIM)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and TF-IDF values, of length 1 in all."""
    n = counts(text)
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, x / (np.linalg.norm(x) or 1.0)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Texts with each n-gram, and all texts; one vector for each task is added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                seen[:DIM] += counts(text) > 0
                seen[DIM] += 1
        yield pd.DataFrame({"gram": np.arange(DIM + 1), "n": seen})

    found = texts.select("text").mapInPandas(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(DIM + 1, np.int64)
    for gram, n in found.collect():  # DIM + 1 rows, whatever the input
        out[gram] = n
    return out[:DIM], int(out[DIM])


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> np.ndarray:
    """FTRL-proximal over (class, indices, values), a softmax for each row."""
    z, n, w = (np.zeros((DIM, classes)) for _ in range(3))
    for _ in range(EPOCHS):
        for y, at, x in rows:
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            w[at] = wi
            s = x @ wi
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] += g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the scores under which the true classes are likeliest.

    One label in 500 counts as random, so texts that are easily told apart stay below 1.
    """
    k = scores.shape[1] if len(scores) else 1
    wanted = np.full((len(scores), k), 0.002 / k)
    wanted[np.arange(len(scores)), truth] += 0.998

    def loss(t: float) -> float:
        s = scores / t
        top = s.max(1)
        return float(np.mean(np.log(np.exp(s - top[:, None]).sum(1)) + top - (wanted * s).sum(1)))

    return min(np.geomspace(0.02, 20, 121), key=loss) if len(scores) else 1.0


def _sample(known: DataFrame) -> list[tuple[str, str, bool]]:
    """At most about TRAIN_DOCS + CALIBRATION_DOCS (lang, text, calibrate), equal for each language, chosen by hash."""
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    share = (TRAIN_DOCS + CALIBRATION_DOCS) / len(sizes)
    keep = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, int(min(1.0, share / n) * 1_000_000))])
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    part = CALIBRATION_DOCS / (TRAIN_DOCS + CALIBRATION_DOCS)
    rows = known.where(spread < keep[F.col("lang")]).select("lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1000)) < int(1000 * part)).alias("calibrate"))
    return [tuple(r) for r in rows.orderBy(F.xxhash64("doc_id")).collect()]


def predict_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text, lang).

    Learns only from rows with a lang whose crc32 of the id as text is not 2 modulo 4. A
    text that is null or has no letter is ``und`` with score 0, as is everything when
    there is nothing to learn from. A row with a null doc_id is not learned from
    (held_out is true). Repeated rows count as often as they occur. Other columns are
    not read.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(True))
    known = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, total = _document_frequencies(known)
    idf = np.log((1 + total) / (1 + df)) + 1
    rows = [(lang, calibrate, *_features(text, idf)) for lang, text, calibrate in _sample(known) if has_letter(text)]
    names = sorted({r[0] for r in rows})
    number = {lang: k for k, lang in enumerate(names)}
    heat, weights = 1.0, np.zeros((DIM, len(names)))
    if names:
        weights = fit([(number[lang], at, x) for lang, calibrate, at, x in rows if not calibrate], len(names))
        check = [(number[lang], x @ weights[at]) for lang, calibrate, at, x in rows if calibrate]
        if check:
            heat = temperature(np.array([s for _, s in check]), np.array([k for k, _ in check]))
    # DIM weights for each language; of the same size for any number of documents.
    model = spark.sparkContext.broadcast((names, (weights / heat).astype(np.float32), idf.astype(np.float32)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weights, idf = model.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                if not names or not has_letter(text):
                    out.append((UNKNOWN, 0.0))
                    continue
                at, x = _features(text, idf)
                s = x @ weights[at]
                best = int(s.argmax())
                out.append((names[best], float(1 / np.exp(s - s[best]).sum())))
            result = pd.DataFrame(out, columns=["lang_pred", "score"])
            result.insert(0, "held_out", batch["held_out"].array)
            result.insert(0, "doc_id", batch["doc_id"].array)
            yield result

    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInPandas(
        score, "doc_id long, held_out boolean, lang_pred string, score double"
    )
