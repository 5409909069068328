"""Longest common prefixes below a bound, derived from a Burrows-Wheeler transform.

Suffixes are sorted by their first ``least`` characters or more.  Starting from
the empty string, intervals of strings are extended backward by one character at
a time, breadth first, so that common prefixes are found by increasing length; an
interval goes on only if its end wasn't met before.  The search stops at
``least``: neighbours without a value then share that much.
"""

from __future__ import annotations

import numpy as np

_BITS, _PACK = 9, 4  # symbols 0 to 256, four of them in one key


def sorted_by(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of keys of so many bits, and the keys in that order.

    Key and place are sorted as one number where both fit, which is much faster.
    """
    room = max(1, len(key).bit_length())
    if bits + room > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = key.astype(np.int64)
    both <<= room
    both |= np.arange(len(key))
    both.sort()
    order = (both & ((1 << room) - 1)).astype(np.int32)
    both >>= room
    return order, both


def suffix_order(symbols: np.ndarray, least: int) -> np.ndarray:
    """Positions sorted by at least ``least`` symbols, by doubling what is compared."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(_PACK, np.int64)])
    key = np.zeros(n, np.int64)
    for d in range(_PACK):
        key = key << _BITS | padded[d : d + n]
    order, key = sorted_by(key, _BITS * _PACK)
    rank = np.empty(n, np.int32)
    tied = np.arange(n, dtype=np.int32)
    at, size, room = order, _PACK, (n + 1).bit_length()
    while True:
        # the rank of a group of equals is the place of its first
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        last = np.ones(len(at), bool)
        last[:-1] = fresh[1:]
        again = ~(fresh & last)  # only suffixes whose rank is shared are sorted again
        tied = tied[again]
        if size >= least or not len(tied):
            return order
        at = order[tied]
        beyond = at + size
        after = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[at].astype(np.int64)
        key <<= room
        key |= after
        by, key = sorted_by(key, 2 * room)
        at = at[by]
        order[tied] = at
        size *= 2


def undecided(last: np.ndarray, least: int) -> np.ndarray:
    """For the transform ``last`` (0 separates texts): True at j if suffixes j - 1 and j share ``least`` symbols.

    Neighbours of which one ends before that may be True as well.
    """
    n = len(last)
    by_symbol, _ = sorted_by(last, _BITS)
    to = np.empty(n, np.int32)
    to[by_symbol] = np.arange(n, dtype=np.int32)  # place of the suffix that starts one symbol earlier
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    lo, hi = np.zeros(1, np.int32), np.full(1, n - 1, np.int32)
    for _ in range(least):
        one = lo == hi
        single = lo[one]
        single = to[single[last[single] > 0]]
        lo, hi = lo[~one], hi[~one]
        if len(lo):
            sizes = hi - lo + 1
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(lo - (ends - sizes), sizes)
            by, key = sorted_by(np.repeat(np.arange(len(lo)), sizes) << _BITS | last[at], len(lo).bit_length() + _BITS)
            at = at[by]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            stop = np.concatenate([start[1:], [len(key)]]) - 1
            real = (key[start] & ((1 << _BITS) - 1)) > 0
            lo, hi = to[at[start[real]]], to[at[stop[real]]]
        lo, hi = np.concatenate([lo, single]), np.concatenate([hi, single])
        fresh = open_[hi + 1]
        lo, hi = lo[fresh], hi[fresh]
        if not len(lo):
            break
        _, first = np.unique(hi, return_index=True)  # several strings may end at one place
        lo, hi = lo[first], hi[first]
        open_[hi + 1] = False
    return open_[:n]


def repeated(texts: list[bytes], least: int) -> list[np.ndarray]:
    """For each text, at which positions a string of ``least`` bytes starts that also starts at another position."""
    size = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(size + 1)])
    symbols = np.zeros(int(starts[-1]), np.int16)
    whole = np.frombuffer(b"".join(texts), np.uint8)
    inside = np.arange(len(whole)) + np.repeat(np.arange(len(texts)), size)
    symbols[inside] = whole.astype(np.int16) + 1
    found = np.zeros(len(symbols), bool)
    if len(symbols):
        order = suffix_order(symbols, least)
        same = undecided(symbols[order - 1], least)
        room = np.repeat(starts[1:], size + 1) - 1 - np.arange(len(symbols))
        long = room[order] >= least
        same[1:] &= long[1:] & long[:-1]
        hit = same.copy()
        hit[:-1] |= same[1:]
        found[order[hit]] = True
    return [found[a : a + n] for a, n in zip(starts[:-1].tolist(), size.tolist(), strict=True)]
