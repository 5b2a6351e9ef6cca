"""Vectorized text helpers that run inside Arrow tasks.

A block is a list of UTF-8 byte strings joined by newlines, at most
``BLOCK_BYTES`` long unless a single text is longer; all arrays of a task
are proportional to one block, never to its whole batch or partition.
Texts are always processed whole.

Fingerprints are polynomials over the bytes modulo 2**64, finished with a
bit mixer. Every constant comes from a fixed seed, so all tasks, retries
and reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64

_rng = np.random.default_rng(20240229)
_BYTE_CODES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * U64(2) + U64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD_BASE = U64(0xC2B2AE3D27D4EB4F)


def byte_class(spec: str) -> np.ndarray:
    """Boolean table over byte values for a character class such as
    ``"\\x00-\\x2F"`` given as (low, high) pairs of characters."""
    table = np.zeros(256, bool)
    for low, high in zip(spec[::2], spec[1::2]):
        table[ord(low):ord(high) + 1] = True
    return table


#: Separators of `[^\x20\x09-\x0D]+` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
BLANKS = byte_class("\x20\x20\x09\x0d")
NON_ALNUM = byte_class("\x00\x2f\x3a\x60\x7b\x7f")
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing mixer: a bijection of 64-bit values that spreads all bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n (B is odd, so it has an inverse)."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        base = _BASES[which]
        out = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, U64(b), np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 8 * BLOCK_BYTES:
            _powers[which] = have
    return have


class Rolling:
    """Fingerprints of any byte ranges of a buffer in constant time each."""

    def __init__(self, buf: np.ndarray, which: int = 0):
        power, self._inverse = _power_tables(which, len(buf) + 1)
        self._sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[which][buf] * power[:len(buf)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])


def batch_bytes(column) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) whose texts together stay within ``limit`` bytes
    (a longer text forms a block of its own)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """Words of a block of texts.

    ``buf`` holds the (folded) bytes; ``start``/``end`` delimit words;
    the words of text ``d`` are ``first[d]:first[d + 1]``.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray, fold: bool = True):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.buf = FOLD[raw] if fold else raw
        inside = np.empty(len(raw) + 1, np.int8)
        inside[0] = 0
        inside[1:] = ~separators[self.buf]
        step = np.diff(inside)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=self.offset[1:])
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return Rolling(self.buf).of(self.start, self.end)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words starting at each position; length len(words)-k+1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, k):
        h = h * _WORD_BASE + words[i:i + n]
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values; length len(x)-w+1."""
    return _sliding(x, w, np.minimum)


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    return _sliding(x, w, np.maximum)


def _sliding(x, w, op):
    if len(x) < w:
        return x[:0]
    span, out = 1, x
    while span * 2 <= w:
        out = op(out[:-span], out[span:])
        span *= 2
    return out if span == w else op(out[:len(x) - w + 1], out[w - span:])


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], marked.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cover(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Boolean array of length n, true inside any of the ranges."""
    depth = np.bincount(start, minlength=n + 1)
    depth -= np.bincount(end, minlength=n + 1)
    return np.cumsum(depth[:n]) > 0
