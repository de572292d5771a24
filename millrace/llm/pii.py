"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns find what has a strict form. The field finds what they miss. Its nodes are
values: the patterns' matches, e-mail written out, what a word like "token" assigns with a
colon or an equals sign (letters alone, too), groups of nine digits or more, names of known
mailboxes, and tokens with a digit or an @. Other words are no nodes but features of the
values beside them. Values near each other on a line share a potential, and so do values
of one document that are alike wherever they stand: the same letters and digits, the same
last nine digits, or a mailbox with and without its domain. Matches are evidence, to which every
value like one is joined, so loopy sum-product messages carry it in one step; they go on
until they change no more.

The weights are fitted by pseudo-likelihood on at most TRAIN_DOCS documents, labelled by
the patterns, with secrets (a kind of the field only) labelled where a word like "token"
assigns them, and on EXAMPLES lines made by rule, as written-out e-mail and secrets of
letters are too rare to be learnt from a sample.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import prepare

KINDS = ["email", "ip", "card", "phone", "secret"]
LABELS = ["none", *KINDS]
TRAIN_DOCS = 3000
# Longer texts are not learnt from, which bounds what the driver holds.
TRAIN_BYTES = 100_000
EXAMPLES = 600
DIM = 1 << 14
STEPS = 150
# Messages have settled when none changes more; the rounds are only a stop for a loop that swings.
SETTLED, ROUNDS = 1e-4, 1000
# Characters between values that share a chain edge.
NEAR = 40
# Digits that two numbers alike have in common.
TAIL = 9
SURE = 0.6

Span = tuple[str, int, int]

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_CANDIDATE = re.compile(r"\S*[0-9@]\S*")
_TRIM = re.compile(r"\+?\(?[^\W_](?:\S*[^\W_])?")
_WORD_BEFORE = re.compile(r"(\S+)\s*\Z")
_WORD_AFTER = re.compile(r"\s*(\S+)")
_WRITTEN = re.compile(
    r"(?i)\b[a-z0-9_+-]+(?:(?: dot |\.)[a-z0-9_+-]+)*(?: at [a-z0-9-]+(?: dot [a-z0-9-]+)+| ?[\[(]at[\])] ?[a-z0-9-]+(?:(?: dot |\.| ?[\[(]dot[\])] ?)[a-z0-9-]+)+)\b"
)
_AT = re.compile(r"(?i) at | ?[\[(]at[\])] ?")
_DOT = re.compile(r"(?i) dot | ?[\[(]dot[\])] ?")
_NUMBER = re.compile(r"(?<![\w.+])\(?[0-9](?:[ ().-]{0,2}[0-9]){8,18}(?!\w)")
_GIVEN = re.compile(r"(?i)\b(?:token|key|secret|password|passwd|pwd|credential)s?\b[\"']?\s*[:=]\s*[\"']?([^\s\"',;<>@/]{8,})")
_ASSIGNED = re.compile(r"(?i)\b(?:token|key|secret|password|passwd|pwd|credential)\b\W*\Z")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        d = _digits(text)
        return 13 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by kind, then start; a match that fails its check is dropped."""
    digit = bool(_DIGIT.search(text))
    out = []
    for kind, pattern in PATTERNS.items():
        if ("@" in text) if kind == "email" else digit and (kind != "phone" or "+" in text):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return out


class Tokens:
    """The values of one text, their features, edges and known labels."""

    def __init__(self, text: str, base: list[Span]):
        taken, values = bytearray(len(text)), []

        def add(a: int, b: int, known: int, core: str, kind: int = 0) -> None:
            if a < b and not any(taken[a:b]):
                taken[a:b] = b"\x01" * (b - a)
                values.append((a, b, known, core, kind))

        for kind, a, b in sorted(base, key=lambda s: (s[1], -s[2])):
            add(a, b, LABELS.index(kind), text[a:b])
        email, secret = LABELS.index("email"), LABELS.index("secret")
        if re.search("(?i)dot|[\\[(]at", text):
            for m in _WRITTEN.finditer(text):
                add(m.start(), m.end(), 0, _DOT.sub(".", _AT.sub("@", m[0])), email)
        if ":" in text or "=" in text:
            for m in _GIVEN.finditer(text):
                core = m[1].rstrip(".)]}!?:")
                add(m.start(1), m.start(1) + len(core), 0, core, secret if len(core) >= 8 else 0)
        for _, _, known, core, _ in list(values):
            name = core.split("@")[0]
            if known == email and len(name) >= 6 and not name.isalpha():
                for m in re.finditer(rf"(?<![\w.@-]){re.escape(name)}(?![\w@-])", text):
                    add(m.start(), m.end(), 0, name)
        if _DIGIT.search(text) or "@" in text:
            for m in _NUMBER.finditer(text):
                add(m.start(), m.end(), 0, m[0])
            for m in _CANDIDATE.finditer(text):
                core = _TRIM.search(m[0])
                a, b = (m.start() + core.start(), m.start() + core.end()) if core else m.span()
                add(a, b, 0, text[a:b])
        values.sort()
        self.places = [(a, b) for a, b, *_ in values]
        self.known = [known for _, _, known, _, _ in values]
        self.given = [kind for *_, kind in values]
        self.features = []
        for a, b, _, core, _ in values:
            before, after = _WORD_BEFORE.search(text, max(0, a - NEAR), a), _WORD_AFTER.match(text, b, b + NEAR)
            is_given = _ASSIGNED.search(text, max(0, a - 30), a) is not None
            self.features.append(_features(core, before[1] if before else "", after[1] if after else "", is_given))
        # Neighbours on one line, and values that are alike: with the first that is known, else with the next.
        gaps = [text[values[i][1] : values[i + 1][0]] for i in range(len(values) - 1)]
        chain = [(i, i + 1) for i, gap in enumerate(gaps) if len(gap) <= NEAR and "\n" not in gap]
        self.adjacent = {i + 1 for i, gap in enumerate(gaps) if not gap.strip(" \t")}
        alike: dict[tuple[str, str], list[int]] = {}
        for i, (_, _, _, core, _) in enumerate(values):
            for key in _likeness(core):
                alike.setdefault(key, []).append(i)
        skip = set()
        for group in alike.values():
            known = next((i for i in group if self.known[i]), None)
            if known is None:
                skip |= set(zip(group, group[1:], strict=False))
            else:
                skip |= {(min(known, i), max(known, i)) for i in group if i != known}
        self.chain = np.array(chain, np.int64).reshape(-1, 2)
        self.skip = np.array(sorted(skip), np.int64).reshape(-1, 2)
        self.text = text

    def training_labels(self) -> np.ndarray:
        """The known labels, also of what is like them, e-mail that is written out, and secrets that a word assigns."""
        out = np.array(self.known, np.int64)
        for i, (a, b) in enumerate(self.places):
            core = self.text[a:b]
            if out[i]:
                continue
            out[i] = self.given[i]
            if not out[i] and len(core) >= 16 and core.isalnum() and not core.isdigit() and _ASSIGNED.search(self.text, max(0, a - 30), a):
                out[i] = LABELS.index("secret")
        for i, j in self.skip.tolist():
            # What is like a match is what the match is.
            if self.known[i] or self.known[j]:
                out[i], out[j] = (self.known[i] or self.known[j],) * 2 if not (self.known[i] and self.known[j]) else (self.known[i], self.known[j])
        return out


def _likeness(core: str) -> Iterator[tuple[str, str]]:
    """What values that are alike have in common."""
    letters, digits, name = re.sub(r"[\W_]", "", core).lower(), _digits(core), core.split("@")[0].lower()
    if len(letters) > 3:
        yield "same", letters
    if len(digits) >= TAIL:
        yield "digits", digits[-TAIL:]
    if len(name) >= 6 and not name.isdigit():
        yield "mailbox", name


def examples() -> list[str]:
    """Lines made by rule, the same each time: written-out e-mail, assigned secrets, numbers and words that are neither, values alike."""
    chance, out = random.Random(6), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda a, b, signs=letters: "".join(chance.choices(signs, k=chance.randint(a, b)))
    for k in range(EXAMPLES):
        name, trigger = word(3, 8), chance.choice(["token", "key", "secret", "password", "pwd"])
        lines = [
            f"{word(3, 7)} {name} dot {word(3, 8)} at {word(3, 8)} dot {word(2, 4)} {word(3, 7)}",
            f"{word(3, 7)} {trigger}{chance.choice([': ', ' = ', '='])}{word(9, 24, letters + (letters.upper() + '0123456789' if k % 2 else ''))} {word(3, 7)}",
            f"{word(3, 7)} {chance.randint(1, 9)} {chance.randint(100, 999)} {chance.randint(100, 999)} {chance.randint(100, 999)} {word(3, 7)}",
            f"{word(3, 7)} {word(4, 9)}{chance.randint(1, 99)} {word(3, 7)} {chance.randint(1900, 2030)} {word(2, 6)} {chance.randint(0, 99)}.{chance.randint(0, 9)}",
        ]
        digits, mailbox = "".join(chance.choices("0123456789", k=10)), f"{word(3, 7)}.{word(3, 7)}{chance.randint(1, 99)}"
        again = chance.choice([f"49{digits}", f"0{digits}", f"0{digits[:3]} {digits[3:]}", f"({digits[:3]}) {digits[3:]}"])
        lines += [
            f"{word(3, 7)} +49 {digits[:3]} {digits[3:6]} {digits[6:]} {' '.join(word(2, 8) for _ in range(20))} {again} {word(3, 7)}",
            f"{word(3, 7)} {mailbox}@{word(3, 8)}.org {' '.join(word(2, 8) for _ in range(20))} {mailbox} {word(3, 7)}",
        ]
        out.append(lines[k % len(lines)])
    return out


def _features(core: str, before: str, after: str, is_given: bool) -> list[int]:
    shape = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", core)))
    short = re.sub(r"(.)\1+", r"\1", shape)
    digits = sum(c.isdigit() for c in core)
    names = [
        "bias", f"short={short if len(short) < 12 else 'long'}", f"length={min(len(core), 48) // 4}", f"digits={min(digits, 24)}", f"exact={shape if len(shape) < 24 else ''}",
        f"before={re.sub(r'[0-9]', '9', before.lower())[-12:]}", f"after={re.sub(r'[0-9]', '9', after.lower())[:12]}", f"at={'@' in core}", f"dots={core.count('.')}",
        f"given={is_given}", f"given={is_given}/{min(len(core), 16) // 4}/{core.isalnum()}", f"hex={re.fullmatch('[0-9a-fA-F]+', core) is not None}", f"mixed={digits > 0 and digits < len(core)}/{min(len(core), 40) // 8}",
    ]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % DIM for x in names]


class Field:
    """Weights of features, of neighbouring labels and of labels of tokens that are alike."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, tokens: Tokens) -> np.ndarray:
        """Beliefs when damped messages along both kinds of edges have settled."""
        k = len(LABELS)
        own = self.unary[np.array(tokens.features)].sum(1)
        own = np.exp(own - own.max(1, keepdims=True))
        known = np.array(tokens.known)
        own[known > 0] = np.eye(k)[known[known > 0]] + 1e-9
        own /= own.sum(1, keepdims=True)
        edges = np.concatenate([tokens.chain, tokens.skip])
        if not len(edges):
            return own
        is_skip = np.arange(len(edges)) >= len(tokens.chain)
        pair = np.where(is_skip[:, None, None], np.exp(self.skip), np.exp(self.chain))
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.full((len(source), k), 1 / k)
        log_own = np.log(own + 1e-12)
        for _ in range(ROUNDS):
            log_message = np.log(message)
            total = log_own.copy()
            np.add.at(total, target, log_message)
            out = total[source] - log_message[back]
            out = np.exp(out - out.max(1, keepdims=True))
            new = (out[:, :, None] * pair).sum(1)
            new /= new.sum(1, keepdims=True)
            change = np.abs(new - message).max()
            message = 0.5 * message + 0.5 * new
            if change < SETTLED:
                break
        belief = log_own.copy()
        np.add.at(belief, target, np.log(message))
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)


def fit(texts: list[str]) -> Field:
    """Pseudo-likelihood: each token's label given its features and the labels beside it."""
    k = len(LABELS)
    features, labels, left, right, alike = [], [], [], [], []
    for text in texts:
        tokens = Tokens(text, base_spans(text))
        y = tokens.training_labels()
        near = np.full((2, len(y)), -1)
        near[0, tokens.chain[:, 1]] = y[tokens.chain[:, 0]]
        near[1, tokens.chain[:, 0]] = y[tokens.chain[:, 1]]
        same = np.zeros((len(y), k))
        np.add.at(same, tokens.skip[:, 0], np.eye(k)[y[tokens.skip[:, 1]]])
        np.add.at(same, tokens.skip[:, 1], np.eye(k)[y[tokens.skip[:, 0]]])
        features += tokens.features
        labels.append(y)
        left.append(near[0])
        right.append(near[1])
        alike.append(same)
    # Equal labels of tokens that are alike are favoured even if the sample has none.
    unary, before, behind, skip = np.zeros((DIM, k)), np.zeros((k + 1, k)), np.zeros((k + 1, k)), 1.5 * np.eye(k)
    unary[zlib.crc32(b"bias") % DIM, 0] = 1.0
    if features:
        x, y = np.array(features), np.concatenate(labels)
        eye = np.eye(k + 1)[:, :k]
        one, two, same = eye[np.concatenate(left)], eye[np.concatenate(right)], np.concatenate(alike)
        sums = [np.full(a.shape, 1e-6) for a in (unary, before, behind, skip)]
        n = len(y)
        for _ in range(STEPS):
            s = unary[x].sum(1) + one @ before[:k] + two @ behind[:k] + same @ skip
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y] -= 1
            g = np.stack([np.bincount(x.ravel(), np.repeat(p[:, c], x.shape[1]), DIM) for c in range(k)], 1) / n + 1e-5 * unary
            grads = [g, np.vstack([one.T @ p / n, np.zeros(k)]) + 1e-4 * before, np.vstack([two.T @ p / n, np.zeros(k)]) + 1e-4 * behind, same.T @ p / n]
            for w, g, total in zip((unary, before, behind, skip), grads, sums, strict=True):
                total += g * g
                w -= 0.3 * g / np.sqrt(total)
    return Field(unary, (before[:k] + behind[:k].T) / 2, (skip + skip.T) / 2)


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """What the field finds outside the base spans: runs of neighbouring tokens of one kind."""
    tokens = Tokens(text, base)
    if not tokens.places:
        return []
    belief = field.marginals(tokens)
    best = belief.argmax(1)
    taken = np.zeros(len(best), bool)
    taken[[bool(k) for k in tokens.known]] = True
    out: list[Span] = []
    last = -2
    for i, label in enumerate(best.tolist()):
        if not label or taken[i] or belief[i, label] < SURE:
            continue
        a, b = tokens.places[i]
        if out and last == i - 1 and i in tokens.adjacent and out[-1][0] == LABELS[label]:
            out[-1] = (out[-1][0], out[-1][1], b)
        else:
            out.append((LABELS[label], a, b))
        last = i
    return out


def _train(docs: DataFrame) -> Field:
    """Fit on at most about TRAIN_DOCS texts with a digit or an @, chosen by hash, and on the examples."""
    some = docs.where(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= TRAIN_BYTES))
    n = some.count()
    part = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(min(1.0, TRAIN_DOCS / max(n, 1)) * 1_000_000)
    return fit([r["text"] for r in some.where(part).select("text").distinct().orderBy("text").collect()] + examples())


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span as <kind>; overlapping spans become the first of them."""
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind}>"]
            at = b
        elif b > at:
            at = b
    return "".join([*parts, text[at:]])


def _find(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans."""
    base = base_spans(text) if isinstance(text, str) else []
    return base, base + (added_spans(text, base, field) if isinstance(text, str) else [])


def _shared(docs: DataFrame):
    """The fitted field for all tasks: DIM weights for each kind, whatever the number of documents."""
    field = _train(docs)
    return docs.sparkSession.sparkContext.broadcast((field.unary.astype(np.float32), field.chain, field.skip))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row of ``docs`` (doc_id, text).

    The counts and base_sha256 are of the patterns' matches, spans of all: kind:start:end in
    code points, by kind, then start. A null text counts as empty. Null ids and repeated
    rows are treated like any other; other columns are not read.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    model = _shared(docs)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = Field(*model.value)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, spans = _find(text, field)
                counts = [sum(s[0] == k for s in base) for k in KINDS[:4]]
                out.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest() if base else nothing, _written(spans)))
            result = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            result.insert(0, "doc_id", batch["doc_id"].array)
            yield result

    return docs.mapInPandas(find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, all columns and rows, with each span of the text replaced by its kind; a null text stays null."""
    prepare(docs.sparkSession)
    model = _shared(docs)
    at, names = docs.columns.index("text"), [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*model.value)
        for batch in batches:
            texts = [t if t is None else redacted(t, _find(t, field)[1]) for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return plain.mapInArrow(write, plain.schema).toDF(*docs.columns)
