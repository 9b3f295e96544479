"""Suffix arrays, and an FM-index over a sequence of numbers, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``t`` by prefix doubling; only groups that are not yet told apart are sorted again."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    if n < 2:
        return sa
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = t[sa[1:]] != t[sa[:-1]]
    slots = np.arange(n)
    head = np.maximum.accumulate(np.where(fresh, slots, 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[sa], rank[n] = head, -1
    step = 1
    while True:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        slots, fresh = slots[~alone], fresh[~alone]
        if not len(slots):
            return sa
        suffix = sa[slots]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + step, n)] + 1
        order = np.argsort(key, kind="stable")
        suffix, key = suffix[order], key[order]
        sa[slots] = suffix
        fresh[0], fresh[1:] = True, key[1:] != key[:-1]
        rank[suffix] = np.maximum.accumulate(np.where(fresh, slots, 0))
        step *= 2


class FmIndex:
    """Backward search by ranks in a wavelet tree (kept level by level), places by sampled suffix positions.

    ``t`` holds symbols from 1 on and separators 0; no pattern holds a separator, and none is matched across one.
    """

    SAMPLE = 16

    def __init__(self, t: np.ndarray, symbols: int):
        n = len(t)
        separators = np.flatnonzero(t == 0)
        apart = t.astype(np.int64) + len(separators)
        apart[separators] = np.arange(len(separators))  # all different, so comparing never goes past one
        sa = suffix_array(apart)
        last = t[sa - 1].astype(np.int64)  # of the first suffix: the last symbol, a separator or not searched for
        last[sa == 0] = 0
        self.levels = max(1, int(symbols).bit_length())
        self.ones, self.zeros, current = [], [], last
        for level in range(self.levels - 1, -1, -1):
            bits = (current >> level) & 1
            ones = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(bits, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            current = np.concatenate([current[bits == 0], current[bits == 1]])
        self.last = last
        counts = np.bincount(t, minlength=symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        every = np.arange(symbols + 1, dtype=np.int64)
        self.first = self._down(every, np.zeros(symbols + 1, dtype=np.int64))
        self.sampled = (sa % self.SAMPLE == 0) | (last == 0)  # walks never cross a separator
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = sa[self.sampled]

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.ones[k][at]
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row that begins with ``symbol`` followed by what rows from ``at`` on begin with."""
        return self.before[symbol] + self._down(symbol, at) - self.first[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low <= row < high`` of each pattern (one per line, all of one length)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.last), dtype=np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low[alive], high[alive] = self.step(symbol, low[alive]), self.step(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        high[low > high] = low[low > high]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in ``rows``: back through the text to the next sampled one."""
        rows, walked = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            at = rows[open_]
            rows[open_] = self.step(self.last[at], at)
            walked[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.samples[self.sample_rank[rows]] + walked
