"""An FM-index over a sequence of small integers, in NumPy.

The sequence is cut by zeros; patterns hold none. The suffix order comes from prefix doubling,
ranks from a wavelet matrix, places from suffix positions sampled every few places.
"""
import numpy as np

SAMPLE = 8


def suffix_array(symbols):
    """Order of all suffixes; each zero ends the comparison and is unlike any other zero."""
    n = len(symbols)
    zeros = symbols == 0
    key = symbols.astype(np.int64) + int(zeros.sum())
    key[zeros] = np.arange(int(zeros.sum()))
    order = np.argsort(key, kind="stable")
    rank, step = _ranked(key, order), 1
    while step < n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank, step = _ranked(key, order), step * 2
    return order


def _ranked(key, order):
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return rank


class WaveletMatrix:
    """``rank(c, i)``: how often symbol ``c`` occurs before place ``i``, for arrays of both."""

    def __init__(self, symbols, largest):
        self.levels = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (symbols >> bit & 1).astype(bool)
            sums = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=sums[1:])
            self.levels.append((bit, sums, len(symbols) - int(sums[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, c, i):
        begin = np.zeros_like(i)
        for bit, sums, zeros in self.levels:
            one = (c >> bit & 1).astype(bool)
            begin = np.where(one, zeros + sums[begin], begin - sums[begin])
            i = np.where(one, zeros + sums[i], i - sums[i])
        return i - begin


class FMIndex:
    def __init__(self, symbols, largest):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.ranks = WaveletMatrix(self.last, largest)
        counts = np.bincount(symbols, minlength=largest + 2)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        # The first place of each run is sampled as well, so a walk never crosses a zero.
        sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.sampled, self.place = sampled, np.where(sampled, order, -1)

    def search(self, patterns):
        """Row ranges ``[low, high)`` of patterns of one length, one per row of the matrix."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.last), np.int64)
        alive = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            c = patterns[alive, column]
            low[alive] = self.below[c] + self.ranks.rank(c, low[alive])
            high[alive] = self.below[c] + self.ranks.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows):
        """Places of the suffixes in these rows, by walking back to a sampled one."""
        place = np.empty(len(rows), np.int64)
        walking, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(walking):
            here = self.sampled[rows]
            place[walking[here]] = self.place[rows[here]] + steps
            walking, rows = walking[~here], rows[~here]
            c = self.last[rows]
            rows = self.below[c] + self.ranks.rank(c, rows)
            steps += 1
        return place
