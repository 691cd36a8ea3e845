"""Rolling hashes over Arrow string columns, in numpy.

A batch of texts is taken as one byte array with offsets; words, lines and n-grams of all its texts are cut and
hashed together. A span's hash is a difference of prefix sums, so each n-gram length costs a few array operations.
Hashes are 64 bits, from fixed constants: equal on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(_BASE))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Powers:
    """base**i and base**-i modulo 2**64, extended as longer texts come."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, base, U)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=U))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(_WORD_BASE)


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of runs of whole texts, of about ``size`` bytes each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind, n + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of marked bytes; runs end with their text."""
    n = len(inside)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    if n:
        start[heads], end[tails] = inside[heads], inside[tails]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(offsets, s, "right") - 1


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes."""
    up, down = _BYTES.to(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(_BASE))


def hash_windows(tokens: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of each run of n tokens that lies in one text."""
    m = len(tokens) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    up, down = _WORDS.to(len(tokens) + 1)
    total = np.zeros(len(tokens) + 1, U)
    np.cumsum(tokens * up[: len(tokens)], out=total[1:])
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return at, mix((total[at + n] - total[at]) * down[at] + U(n))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number of each word: a maximal run without ASCII white space."""
    return runs(~SPACE[data], offsets)


def code_points_before(data: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte position."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a window of n tokens that begins at one of ``at``."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + n, size), -1)
    return np.cumsum(step[:-1]) > 0


def repeated(keys: np.ndarray, later_only: bool = False) -> np.ndarray:
    """Which keys occur more than once; with later_only, which equal one before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    k = keys[order]
    same[1:] = k[1:] == k[:-1]
    if not later_only:
        same[:-1] |= k[1:] == k[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out
