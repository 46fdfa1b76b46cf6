"""Anchored runs: how repeated windows of any sequence are found without shuffling all positions.

Every window of W symbols is anchored at its K-gram of the lowest identifier, the leftmost among equals, so equal
windows are anchored at equal K-grams in equal places. Consecutive windows with one anchor form a run; runs, a few for
each W symbols, are what is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Window starts that are worked on at once, and bits that hold a place among them and the symbols of the last window.
PIECE, PLACE_BITS = 1 << 20, 21


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of the pair of two identifiers."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _lowest(key: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys."""
    n, m, size = len(key) - width + 1, key, 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:n], m[width - size : width - size + n])


def runs(grams: np.ndarray, k: int, window: int, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sequence, anchor, first and last window start of each run, in places of the whole array.

    grams: identifier of the k symbols from each place of sequences laid end to end (k-1 fewer than symbols).
    ends: the place after each sequence.
    """
    mask = np.uint64((1 << PLACE_BITS) - 1)
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total - window + 1, PIECE):
        n = min(PIECE, total - window + 1 - at)
        part = grams[at : at + n + window - k]
        key = part & ~mask | np.arange(len(part), dtype=np.uint64)
        anchor = (_lowest(key, window - k + 1) & mask).astype(np.int64)
        start = np.arange(at, at + n)
        of = np.searchsorted(ends, start, side="right")
        fits = start + window <= ends[of]
        edge = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (fits[1:] != fits[:-1]) | (of[1:] != of[:-1])])
        last = np.r_[edge[1:], n] - 1
        ok = fits[edge]
        yield of[edge[ok]], anchor[edge[ok]] + at, edge[ok] + at, last[ok] + at
