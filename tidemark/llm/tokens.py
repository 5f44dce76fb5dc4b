"""Vectorised word spans and hashes over blocks of UTF-8 texts.

Words are runs of bytes other than space and \\t\\n\\v\\f\\r; these bytes never
occur inside a multi-byte character, so bytes and code points agree.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
WORD_BASE = 0xD1342543DE82EF95


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(base: int, size: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``size``."""
    return _powers(base, 1 << max(10, (size - 1).bit_length()))[:size]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole hash (64-bit finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed polynomial hash of each span of ``values``, from one prefix sum."""
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values.astype(np.uint64) * powers(base, len(values)), out=sums[1:])
    shift = powers(inverse(base), len(values) + 1)[starts]
    size = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * shift + size * np.uint64(BASE))


class Block:
    """Texts laid end to end, with the spans of their words."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.raw, np.uint8)
        self.at = np.zeros(len(texts) + 1, np.int64)  # first byte of each text
        np.cumsum([len(t) + 1 for t in texts], out=self.at[1:])
        blank = SPACES[self.data]
        self.blank = blank
        before = np.empty_like(blank)
        before[0] = True
        before[1:] = blank[:-1]
        self.starts = np.flatnonzero(before & ~blank)
        self.ends = np.flatnonzero(blank & ~before)
        self.first = np.searchsorted(self.starts, self.at)  # first word of each text
        self.n_words = np.diff(self.first)

    def word_text(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, BASE)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each text."""
        return sums_between(flags, self.at)

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words that lie in one text."""
        room = np.maximum(self.n_words - size + 1, 0)
        skipped = np.repeat(self.first[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room)
        return np.arange(room.sum()) + skipped


def sums_between(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive positions ``at``."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind != "f" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span of ``size`` from one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:n]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    found = np.empty(len(keys), bool)
    found[order] = same[1:] | same[:-1]
    return found
