"""Words, rolling hashes and winnowing over whole columns of text, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _table() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return low, word


LOWER, WORD = _table()


@lru_cache(maxsize=2)
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << max(12, (n - 1).bit_length())
    return _powers(size, inverse)[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of the rows of a chunk: runs of ASCII letters, digits and all of U+0080 and up; A-Z lower-cased."""

    def __init__(self, at: np.ndarray, raw: np.ndarray) -> None:
        self.rows = len(at) - 1
        self.low = LOWER[raw]
        inside = WORD[self.low]
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        firsts = at[:-1][at[:-1] < at[1:]]
        before[firsts] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        after[firsts - 1] = False  # of the row before; row 0 sets the last byte, which has none after
        self.end = np.flatnonzero(inside & ~after) + 1
        #: First word of each row, and the end.
        self.at = np.searchsorted(self.start, at)
        n = len(raw)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * powers(n) if n else self.low.astype(np.uint64), out=sums[1:])
        self.hash = mixed((sums[self.end] - sums[self.start]) * powers(n, True)[self.start]) if n else np.zeros(0, np.uint64)

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, also across rows."""
        n = max(0, len(self.hash) - k + 1)
        out = np.zeros(n, np.uint64)
        for d in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + self.hash[d : d + n]
        return mixed(out)

    def starts(self, k: int) -> np.ndarray:
        """True for each word from which on its row has k words."""
        n = max(0, len(self.hash) - k + 1)
        ends = np.repeat(self.at[1:], self.counts())[:n]
        return np.arange(n) + k <= ends

    def slice(self, i: int, j: int) -> list[str]:
        return [self.low[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)]


def parts(raw: np.ndarray, shared: int, size: int) -> Iterator[tuple[int, Words]]:
    """One text in parts of about ``size`` bytes, as (words before the part, its words).

    Every part but the first starts with the last ``shared`` words of the one before and has a word more at least; a part is cut
    between words and has ``shared`` words and one more, so it grows where words are very long.
    """
    lo, before, least = 0, 0, 0
    while True:
        hi, step = lo, size
        while True:
            hi = min(len(raw), hi + step)
            while hi < len(raw) and WORD[LOWER[raw[hi - 1 : hi + 1]]].all():  # inside a word
                ahead = np.flatnonzero(~WORD[LOWER[raw[hi : hi + 4096]]])
                hi = min(len(raw), hi + (int(ahead[0]) if len(ahead) else 4096))
            w = Words(np.array([0, hi - lo]), raw[lo:hi])
            if hi == len(raw) or len(w.start) > shared:
                break
            step *= 2
        if len(w.start) > least or not before:
            yield before, w
        if hi == len(raw):
            return
        skip, least = len(w.start) - shared, shared
        before += skip
        lo = lo + int(w.start[skip]) if shared else hi


def winnow(grams: np.ndarray, whole: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least gram of every window of ``window`` grams, the last of equal ones.

    ``whole[i]`` says that the window from i on lies in one row.
    """
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n], np.arange(n)
    for d in range(1, window):
        now = grams[d : d + n]
        take = now <= best
        best, at = np.where(take, now, best), np.where(take, np.arange(d, d + n), at)
    return np.unique(at[whole[:n]])
