"""Super-windows: the thin carrier both substring operators share.

Every fixed-size window of a sequence (20 words, 100 bytes) contains a
smallest ``k``-gram hash, its anchor (the right-most, if it occurs repeatedly).
Consecutive windows with the anchor at the same place form one super-window, so a sequence is covered by few of them (about
``2 / (window - k + 2)`` per position) and equal windows always share the
anchor hash and the offset to it.  A super-window is described by the range of
window starts, the anchor hash and two hashes of its content.
"""

from __future__ import annotations

import numpy as np

from panelspark.llm.common import MIX_A, mix64, powers

MULT1 = 0x9E3779B97F4A7C15    # fixed values: two odd multipliers for independent hashes
MULT2 = 0xD6E8FEB86659FD93


class Prefix:
    """Hashes of arbitrary ranges of a value sequence from prefix sums of
    value * mult**i; dividing by mult**start makes equal ranges equal."""

    def __init__(self, values: np.ndarray, mult: int):
        n = len(values)
        p = powers(n + 1, mult)
        self.inv = powers(n + 1, pow(mult, -1, 1 << 64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * p[:n], out=self.sums[1:])

    def ranges(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.inv[lo]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return (self.sums[k:] - self.sums[:-k]) * self.inv[:n - k + 1]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values by doubling."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < w:
        x = np.minimum(x[:len(x) - (w - span)], x[w - span:])
    return x


def _runs(values: np.ndarray, seq_starts: np.ndarray, window: int, k: int):
    """First and last start and anchor of every super-window, and the prefix sums."""
    p1 = Prefix(values, MULT1)
    grams = mix64(p1.grams(k))
    low = sliding_min(grams, window - k + 1)                 # one per window start
    m = len(low)
    ok = np.zeros(m + 1, np.int64)                           # +1 / -1 where valid starts begin and end
    full = np.flatnonzero(np.diff(seq_starts) >= window)
    np.add.at(ok, seq_starts[full], 1)
    np.add.at(ok, seq_starts[full + 1] - window + 1, -1)
    ok = np.cumsum(ok[:m]) > 0
    brk = np.ones(m, bool)
    # a change of the minimum, of validity or of the sequence ends a super-window
    brk[1:] = (low[1:] != low[:-1]) | (ok[1:] != ok[:-1])
    brk[seq_starts[full]] = True
    # of equal smallest grams the right-most is the anchor: so does a new one
    brk |= grams[window - k:] == low
    first = np.flatnonzero(brk)
    last = np.append(first[1:], m) - 1
    keep = ok[first]
    return first[keep], last[keep], low[first[keep]], p1


def anchors(values: np.ndarray, seq_starts: np.ndarray, window: int, k: int) -> np.ndarray:
    """Anchor of every super-window."""
    if len(values) < window:
        return np.zeros(0, np.uint64)
    return _runs(values, seq_starts, window, k)[2]


def super_windows(values: np.ndarray, seq_starts: np.ndarray, window: int, k: int):
    """Super-windows of every sequence in the concatenated ``values`` (uint64).

    Returns (seq, lo, hi, anchor, h): sequence number, first and last window
    start relative to the sequence, anchor hash and content hash.  Equal
    super-windows (same content, same range) have equal hashes; together with the
    anchor the content is known by 128 bits.
    """
    if len(values) < window:
        none, u = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return none, none, none, u, u
    first, last, low, p1 = _runs(values, seq_starts, window, k)
    h = mix64(p1.ranges(first, last + window) + (last - first).astype(np.uint64) * MIX_A)
    seq = np.searchsorted(seq_starts, first, "right") - 1
    # empty sequences share a start; the right-most one with that start holds it
    base = seq_starts[seq]
    return seq, first - base, last - base, low, h


def window_hashes(values: np.ndarray, window: int):
    """Two independent content hashes of every window of one sequence."""
    p1, p2 = Prefix(values, MULT1), Prefix(mix64(values + MIX_A), MULT2)
    return mix64(p1.grams(window)), mix64(p2.grams(window))
