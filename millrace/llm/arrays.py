"""Words, shingles and rolling hashes of whole texts as numpy arrays.

Texts are handled a few MB at a time, so a task needs memory for its longest text
and one chunk, whatever the number of rows. Hashes are 64-bit and depend on content
alone, so every task and every run gives the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20

# The word separators of the contracts: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    """Powers of the hash base, for at least ``n`` bytes."""
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * len(_powers), CHUNK_BYTES)
        factor = np.full(n, _BASE, np.uint64)
        factor[0] = 1
        _powers = np.cumprod(factor, dtype=np.uint64)
        factor[1:] = _BASE_INVERSE
        _inverses = np.cumprod(factor, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(text: str | None) -> bytes:
    """The text as UTF-8; none for a null."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def chunks(values: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive values of about ``limit`` bytes, one value at least."""
    start = total = 0
    for i, value in enumerate(values):
        if i > start and total + len(value) > limit:
            yield start, i
            start, total = i, 0
        total += len(value)
    if start < len(values):
        yield start, len(values)


class Rolling:
    """Hashes of any byte ranges of one buffer, each in constant time."""

    def __init__(self, data: np.ndarray):
        _grow(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * _inverses[start])

    def grams(self, size: int) -> np.ndarray:
        """The hash at every position that has ``size`` bytes left."""
        n = max(0, len(self.prefix) - size)
        return mix((self.prefix[size : size + n] - self.prefix[:n]) * _inverses[:n])


def join(values: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All values in one buffer with ``gap`` after each, and where each starts (and the end)."""
    sizes = np.fromiter((len(v) + len(gap) for v in values), np.int64, len(values))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(gap.join([*values, b""]), np.uint8), starts


def words(values: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all values in order, and where each value's words start (and the end)."""
    data, starts = join(values)
    if lower:
        data = LOWER[data]
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    return Rolling(data).of(first, last), np.searchsorted(first, starts)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; one for the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0xD1342543DE82EF95) + words[k : k + n])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)
