"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters. Each is tagged toxic or not from its own form, its first
bytes and its neighbours, and from the tag before it; all features are hashed into
weights of a fixed size. Only documents are labelled, so tokens get labels first: in a
toxic document those whose form or beginning occurs in toxic documents far more often
than elsewhere. The field is then fitted to the labelled tokens by gradient descent on
its likelihood, twice, the second time on labels that the first fit corrected.

Forward-backward gives each token a marginal. A document's score is a logistic
regression on the sum, the mean and the largest of its marginals, fitted on documents
that the field was not fitted on. The spans are runs of tokens above one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .frames import prepare, remainder

# Labelled documents for the fit, at most about so many of each label; a fifth of them
# sets the document score.
TRAIN_DOCS = 1500
# Longer texts, in bytes, are not learnt from, which bounds what the driver holds; they are scored whole.
TRAIN_BYTES = 100_000
DIM = 1 << 18
PREFIXES = (4, 5, 6, 8)
SEGMENT = 128
STEPS = 40

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def tokens(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features of each token, first bytes, end bytes, where each value's tokens start and the end).

    ``values`` are folded texts; the features are indices below DIM: the form, its
    beginnings and the forms before and behind it.
    """
    data, starts = arrays.join(values)
    inside = np.concatenate([[False], LETTER[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    bounds = np.searchsorted(first, starts)
    rolling = arrays.Rolling(data)
    form = rolling.of(first, last)
    kinds = [form] + [rolling.of(first, np.minimum(first + k, last)) for k in PREFIXES]
    for step in (1, -1):
        near = np.roll(form, step)
        near[bounds[:-1][bounds[:-1] < bounds[1:]] if step == 1 else bounds[1:][bounds[:-1] < bounds[1:]] - 1] = 0
        kinds.append(near)
    found = np.stack([arrays.mix(x + np.uint64(k + 1)) >> np.uint64(64 - 18) for k, x in enumerate(kinds)], 1).astype(np.int64)
    return found, first, last, bounds


class _Folding(dict):
    """Lower case of each letter that has one with as many bytes, so offsets hold in every text."""

    def __missing__(self, letter: int) -> str:
        lower = chr(letter).lower()
        self[letter] = lower if len(lower) == 1 and len(arrays.utf8(lower)) == len(arrays.utf8(chr(letter))) else chr(letter)
        return self[letter]


_FOLDING = _Folding()


def folded(text: str | None) -> bytes:
    """A text as it is scored and learnt from; none for a null."""
    return arrays.utf8(text.translate(_FOLDING) if isinstance(text, str) else None)


class Field:
    """Weights of the toxic tag (the other tag's are 0) and of the four tag pairs."""

    def __init__(self, weights: np.ndarray, bias: float, pairs: np.ndarray):
        self.weights, self.bias, self.pairs = weights, bias, pairs

    def unary(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(1) + self.bias

    def marginals(self, unary: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The probability of the toxic tag of each token, by forward-backward along each document.

        Documents are cut into segments that are worked on side by side; a second, short
        pass carries the messages from segment to segment, so the result is exact.
        """
        return _forward_backward(unary, bounds, np.exp(self.pairs))[0]


def _segments(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, continues the document) of segments of at most SEGMENT tokens."""
    sizes = np.diff(bounds)
    n = -(-sizes // SEGMENT)
    doc = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = bounds[:-1][doc] + k * SEGMENT
    return start, np.minimum(bounds[1:][doc] - start, SEGMENT), k > 0


def _forward_backward(unary: np.ndarray, bounds: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the sums of the four pair marginals (from, to)."""
    start, length, goes_on = _segments(bounds)
    m, steps = len(start), int(length.max()) if len(length) else 0
    if not m:
        return np.zeros(0), np.zeros((2, 2))
    place = np.minimum(start[:, None] + np.arange(steps), len(unary) - 1)
    real = np.arange(steps) < length[:, None]
    odds = np.where(real, np.exp(np.clip(unary[place], -30, 30)), 1.0)
    # No tag stands before a document's first token, so either is alike.
    first_pair = np.where(goes_on[:, None, None], pair, 0.5)
    # What a segment does to the message that enters it: a product of 2 x 2 matrices.
    whole = np.tile(np.eye(2), (m, 1, 1))
    for t in range(steps):
        new = whole @ (pair if t else first_pair)
        new[:, :, 1] *= odds[:, t, None]
        new /= new.sum((1, 2))[:, None, None]
        whole = np.where(real[:, t, None, None], new, whole)
    entering = np.full((m, 2), 0.5)
    leaving = np.full((m, 2), 0.5)
    for s in range(m):
        if goes_on[s]:
            x = entering[s - 1] @ whole[s - 1]
            entering[s] = x / x.sum()
    for s in range(m - 1, -1, -1):
        if s + 1 < m and goes_on[s + 1]:
            x = whole[s + 1] @ leaving[s + 1]
            leaving[s] = x / x.sum()
    forward = np.empty((steps + 1, m, 2))
    forward[0] = entering
    for t in range(steps):
        x = forward[t] @ pair if t else (forward[0][:, None, :] @ first_pair)[:, 0]
        x[:, 1] *= odds[:, t]
        forward[t + 1] = np.where(real[:, t, None], x / x.sum(1)[:, None], forward[t])
    back = leaving
    out = np.zeros((m, steps))
    both = np.zeros((2, 2))
    for t in range(steps - 1, -1, -1):
        x = forward[t + 1] * back
        out[:, t] = x[:, 1] / x.sum(1)
        seen = np.stack([back[:, 0], back[:, 1] * odds[:, t]], 1)
        step = pair if t else first_pair
        joint = forward[t][:, :, None] * step * seen[:, None, :]
        total = joint.sum((1, 2))
        counted = real[:, t] & ((t > 0) | goes_on)
        both += (joint[counted] / total[counted][:, None, None]).sum(0)
        x = seen @ pair.T if t else (first_pair @ seen[:, :, None])[:, :, 0]
        back = np.where(real[:, t, None], x / x.sum(1)[:, None], back)
    result = np.empty(len(unary))
    result[place[real]] = out[real]
    return result, both


def fit_field(features: np.ndarray, bounds: np.ndarray, tags: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood with a small L2, by Adagrad over all tokens; ``weight`` is each token's."""
    w, bias, pairs = np.zeros(DIM), -3.0, np.zeros((2, 2))
    gw, gb, gp = np.full(DIM, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    first = np.zeros(len(tags), bool)
    first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[:-1][~first[1:]], tags[1:][~first[1:]]), 1)
    n = max(1, len(tags))
    for _ in range(STEPS):
        p, both = _forward_backward(w[features].sum(1) + bias, bounds, np.exp(pairs))
        error = (p - tags) * weight
        grad = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), DIM) / n + 1e-7 * w
        gw += grad**2
        w -= 0.5 * grad / np.sqrt(gw)
        g = error.mean()
        gb += g * g
        bias -= 0.5 * g / np.sqrt(gb)
        g = (both - seen) / n + 1e-4 * pairs
        g[0, 0] = 0.0  # one of the four is free
        gp += g * g
        pairs = pairs - 0.1 * g / np.sqrt(gp)
    return Field(w, bias, pairs)


def token_labels(features: np.ndarray, bounds: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Tokens of toxic documents whose form or beginning is far commoner in toxic documents."""
    doc = np.repeat(np.arange(len(toxic)), np.diff(bounds))
    out = np.zeros(len(features), np.int64)
    n1, n0 = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    for k in range(1 + len(PREFIXES)):
        pairs = np.unique(doc * DIM + features[:, k])
        grams, label = pairs % DIM, toxic[pairs // DIM]
        bad = np.bincount(grams, label, DIM)
        good = np.bincount(grams, 1 - label, DIM)
        odds = np.log((bad + 0.1) / (n1 + 0.2)) - np.log((good + 0.5) / (n0 + 1))
        out |= ((odds > 1.5) & (bad >= max(4, 0.01 * n1)))[features[:, k]]
    return out * toxic[doc]


def _summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log of the sum, the largest and the mean marginal of each document."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), 3))
    some = sizes > 0
    if some.any():
        total = np.add.reduceat(p, bounds[:-1][some])
        out[some] = np.c_[np.log1p(total), np.maximum.reduceat(p, bounds[:-1][some]), 10 * np.sqrt(total / sizes[some])]
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * weight.sum() * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * weight.sum() * w)
    return w


def fit(rows: list[tuple[int, str, float, bool]]) -> tuple[Field, np.ndarray]:
    """The field and the document weights from (toxic, text, weight, for the document score)."""
    part = [[r for r in rows if r[3] == side] for side in (False, True)]
    field = Field(np.zeros(DIM), -3.0, np.zeros((2, 2)))
    if any(r[0] for r in part[0]) and not all(r[0] for r in part[0]):
        toxic = np.array([r[0] for r in part[0]])
        features, _, _, bounds = tokens([folded(r[1]) for r in part[0]])
        weight = np.ones(len(features))
        tags = token_labels(features, bounds, toxic)
        field = fit_field(features, bounds, tags, weight)
        doc = np.repeat(toxic, np.diff(bounds))
        again = ((field.marginals(field.unary(features), bounds) > 0.5) & (doc == 1)).astype(np.int64)
        field = fit_field(features, bounds, again if again.any() else tags, weight)
    judge = part[1] or part[0]
    if not judge:
        return field, np.zeros(4)
    _, x = _scored(field, [folded(r[1]) for r in judge])
    return field, logistic(x, np.array([r[0] for r in judge], float), np.array([r[2] for r in judge]))


def _scored(field: Field, values: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Marginals with first and end bytes of each value's tokens, and the summaries."""
    found, summaries = [], []
    for i, j in arrays.chunks(values):
        features, first, last, bounds = tokens(values[i:j])
        p = field.marginals(field.unary(features), bounds)
        begin = np.concatenate([[0], np.cumsum([len(v) + 1 for v in values[i:j]])])
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            hot = np.flatnonzero(p[a:b] > 0.5) + a
            found.append((p[hot], first[hot] - begin[k], last[hot] - begin[k]))
        summaries.append(_summary(p, bounds))
    return found, np.concatenate(summaries) if summaries else np.zeros((0, 3))


def _spans(text: str, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Code points (start, end) of the toxic tokens, those with only a gap between them joined."""
    _, first, last = hot
    if not len(first):
        return []
    value = arrays.utf8(text)
    # Code points before each byte.
    before = np.concatenate([[0], np.cumsum((np.frombuffer(value, np.uint8) & 0xC0) != 0x80)])
    out: list[tuple[int, int]] = []
    for a, b in zip(before[first].tolist(), before[last].tolist(), strict=True):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def train(docs: DataFrame, labels: DataFrame) -> tuple[Field, np.ndarray]:
    """Fit on at most about TRAIN_DOCS documents of each label, chosen by hash, none with crc32 0 modulo 5.

    A null label is left out; of several labels for one id the largest counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
        .groupBy(F.col("doc_id").cast("long"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, TRAIN_DOCS / n) for k, n in sizes.items()}
    keep = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < keep * 1_000_000)
    # About 2 * TRAIN_DOCS ids, whatever the input.
    texts = docs.where("text is not null").where(F.octet_length("text") <= TRAIN_BYTES).select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.withColumn("judge", F.pmod(F.xxhash64("doc_id", F.lit("judge")), F.lit(5)) == 0).orderBy("doc_id", "text").collect()
    return fit([(r["toxic"], r["text"], 1 / share[r["toxic"]], r["judge"]) for r in rows])


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (code points) for each row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and toxic. A null or empty text, or one without letters, gets the
    score of no evidence. A null doc_id is held out. Without labels of both kinds all
    scores are alike. Repeated rows are scored alike. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    field, document = train(docs, labels)
    # DIM weights; of the same size for any number of documents.
    model = spark.sparkContext.broadcast((field.weights.astype(np.float32), field.bias, field.pairs, document))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias, pairs, document = model.value
        field = Field(weights, bias, pairs)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            hot, x = _scored(field, [folded(t) for t in texts])
            p = 1 / (1 + np.exp(-np.clip(x @ document[:3] + document[3], -30, 30)))
            spans = [[{"start": a, "end": b} for a, b in _spans(t, h)] for t, h in zip(texts, hot, strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "held_out": batch["held_out"].array, "score": p, "predicted": (p >= 0.5).astype(int), "spans": spans})

    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInPandas(
        score, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start: int, end: int>>"
    )
