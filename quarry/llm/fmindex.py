"""An FM-index over runs of small integers, in numpy: wavelet-matrix ranks, backward search, sampled suffix positions.

The text is runs of symbols 1, 2, ..., each ended by 0. The ends count as different from each other, smaller than any symbol and
ordered by place, so suffixes are in full order after as many doublings as the longest repeat within runs asks for.
"""

from __future__ import annotations

import numpy as np


class Ranks:
    """A wavelet matrix: how often a symbol stands before a place."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        row = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]))
            self.zeros.append(int(len(bit) - bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.before[level][word] + np.bitwise_count(self.bits[level][word] & ((np.uint64(1) << low) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each symbol before each place."""
        start = np.zeros_like(at)
        for i in range(self.levels):
            one = (symbol >> (self.levels - 1 - i) & 1).astype(bool)
            a, b = self._ones(i, start), self._ones(i, at)
            start = np.where(one, self.zeros[i] + a, start - a)
            at = np.where(one, self.zeros[i] + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        symbol = np.zeros_like(at)
        for i in range(self.levels):
            one = (self.bits[i][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones = self._ones(i, at)
            symbol = symbol << 1 | one
            at = np.where(one, self.zeros[i] + ones, at - ones)
        return symbol


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the text in the order of their suffixes; prefix doubling."""
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    known = 1
    while True:
        places = np.argsort(rank, kind="stable")
        ranked = rank[places]
        rank = np.empty_like(rank)
        rank[places] = np.cumsum(np.r_[0, (ranked[1:] != ranked[:-1]).astype(np.int64)])
        size = int(rank.max(initial=0)) + 1
        if size >= len(text):
            return places
        shifted = np.zeros_like(rank)  # what is shifted in stands after an end, which no other suffix shares
        shifted[:-known] = rank[known:]
        rank, known = rank * size + shifted, known * 2


class FmIndex:
    """Of ``text``, runs of symbols 1 and up that each end with 0; suffix positions that ``sample`` divides and starts of runs are kept."""

    def __init__(self, text: np.ndarray, sample: int = 16):
        places = suffix_order(text)
        self.length = len(text)
        self.ranks = Ranks(text[places - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        kept = (places % sample == 0) | (text[places - 1] == 0)  # so no step back passes an end
        self.rows, self.values = np.flatnonzero(kept), places[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows (from, to) of each pattern, by backward search; rows of ``patterns`` are filled from the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.length, np.int64)
        live = np.flatnonzero(lengths > 0)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = live[(lengths[live] >= back) & (low[live] < high[live])]
            symbol = patterns[live, lengths[live] - back].astype(np.int64)
            known = symbol < len(self.first) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            start = self.first[symbol]
            low[live], high[live] = start + self.ranks.rank(symbol, low[live]), start + self.ranks.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps back to the next sampled one."""
        out, steps = np.full(len(rows), -1), 0
        waiting, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(waiting):
            near = np.minimum(np.searchsorted(self.rows, at), len(self.rows) - 1)
            hit = self.rows[near] == at
            out[waiting[hit]] = self.values[near[hit]] + steps
            waiting, at = waiting[~hit], at[~hit]
            symbol = self.ranks.access(at)
            at = self.first[symbol] + self.ranks.rank(symbol, at)
            steps += 1
        return out
