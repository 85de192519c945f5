"""An FM-index over the words of one shard: suffix order, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Positions in suffix order. Every separator is a symbol of its own, smaller than all words, ordered by place.

    `symbols` ends with a separator. Ranks are refined by doubling, and only groups that are still tied are sorted again.
    """
    n = len(symbols)
    seps = int(separators.sum())
    first = np.where(separators, np.cumsum(separators) - 1, seps + symbols.astype(np.int64))
    bits = max(1, int(first.max()).bit_length())
    packed, depth = np.zeros(n, np.int64), 0
    while (depth + 1) * bits <= 62:
        packed <<= bits
        packed[: max(0, n - depth)] |= first[depth:]
        depth += 1
    order = np.argsort(packed, kind="stable")
    key = packed[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    tied = _tied(new)
    slots = np.flatnonzero(tied)
    while len(slots):
        at = order[slots]
        ahead = at + depth
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        by = np.lexsort((follow, rank[at]))
        at, follow = at[by], follow[by]
        group = rank[at]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        slots = slots[_tied(new)]
        depth *= 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Which rows are in a group of more than one, given where groups begin."""
    last = np.ones(len(new), bool)
    last[:-1] = new[1:]
    return ~(new & last)


class WaveletMatrix:
    """Ranks of a sequence of small integers, as one bit vector with running counts for each binary digit."""

    def __init__(self, values: np.ndarray, top: int) -> None:
        self.digits = max(1, int(top).bit_length())
        self.size = len(values)
        self.words: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for digit in range(self.digits - 1, -1, -1):
            bit = ((values >> digit) & 1).astype(bool)
            padded = np.zeros((self.size // 64 + 1) * 64, np.uint8)
            padded[: self.size] = bit
            word = np.packbits(padded, bitorder="little").view(np.uint64)
            count = np.zeros(len(word), np.int64)
            np.cumsum(np.bitwise_count(word[:-1]), out=count[1:])
            self.words.append(word)
            self.counts.append(count)
            self.zeros.append(int(self.size - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        every = np.arange(top + 1)
        self.bottom = self._descend(every, np.zeros(top + 1, np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = self.words[level][at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[level][at >> 6] + np.bitwise_count(word)

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.digits):
            ones = self._ones(level, at)
            bit = (symbol >> (self.digits - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often `symbol` occurs before row `at`."""
        return self._descend(symbol, at) - self.bottom[symbol]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at rows `at`."""
        value = np.zeros(len(at), np.int64)
        for level in range(self.digits):
            bit = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            ones = self._ones(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            value = (value << 1) | bit.astype(np.int64)
        return value


class FmIndex:
    """Backward search over a text of integers 1..top, in which 0 separates stretches that no phrase spans."""

    SAMPLE = 16

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        order = suffix_order(symbols, symbols == 0)
        before = symbols[order - 1]
        before[order == 0] = 0
        self.ranks = WaveletMatrix(before.astype(np.int64), top)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))[:-1]])
        sampled = (order % self.SAMPLE == 0) | (before == 0)
        self.rows = np.flatnonzero(sampled)
        self.places = order[sampled]
        self.size = len(symbols)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of equal length, one in each line; empty ranges where there is none."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self.below[symbol] + self.ranks.rank(symbol, low[alive])
            high[alive] = self.below[symbol] + self.ranks.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to a sampled row, and adds the steps."""
        place = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            slot = np.minimum(np.searchsorted(self.rows, at), len(self.rows) - 1)
            known = self.rows[slot] == at
            place[todo[known]] = self.places[slot[known]] + steps
            todo, at = todo[~known], at[~known]
            symbol = self.ranks.access(at)
            at = self.below[symbol] + self.ranks.rank(symbol, at)
            steps += 1
        return place
