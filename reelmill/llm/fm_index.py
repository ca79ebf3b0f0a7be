"""FM-index over a collection of symbol runs: suffix order, wavelet ranks, sampled positions.

All searches are done for many phrases at once on arrays.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16                 # every 16th position of a run is stored; the rest are walked to


class Bits:
    """A bit vector with constant-time counts of ones before a position."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


def suffix_order(symbols: np.ndarray, to_end: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, each read up to its run's end mark.

    Equal suffixes stand in the order of their positions. ``to_end`` is the distance to
    the end mark. Prefix doubling, started from several symbols packed into one key.
    """
    count = len(symbols)
    width = max(1, int(symbols.max()).bit_length())
    depth = max(1, 62 // width)
    key = np.zeros(count, dtype=np.int64)
    for k in range(depth):
        key <<= width
        reach = max(count - k, 0)
        key[:reach] |= np.where(to_end[:reach] >= k, symbols[k:], 0)
    longest = int(to_end.max()) + 1
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.empty(count, dtype=np.int64)
        fresh[0] = 1
        np.cumsum(np.diff(key[order]) != 0, out=fresh[1:])
        fresh[1:] += 1
        if depth >= longest or fresh[-1] == count:
            return order
        rank = np.empty(count, dtype=np.int64)
        rank[order] = fresh
        key = rank * (count + 1)
        reach = max(count - depth, 0)
        key[:reach] += np.where(to_end[:reach] >= depth, rank[depth:], 0)
        depth *= 2


class FMIndex:
    """Index of ``symbols``: runs of positive symbols, each closed by the end mark 0."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE) -> None:
        count = len(symbols)
        marks = np.flatnonzero(symbols == 0)
        place = np.arange(count)
        run = np.searchsorted(marks, place)
        starts = np.concatenate([[0], marks[:-1] + 1])
        order = suffix_order(symbols, marks[run] - place)
        last = symbols[order - 1]                       # the symbol before each suffix
        self.levels = max(1, int(symbols.max()).bit_length())
        self.first = np.searchsorted(np.sort(symbols), np.arange((1 << self.levels) + 1))
        self.bits: list[tuple[int, Bits, int]] = []
        row = last
        for shift in range(self.levels - 1, -1, -1):
            bit = (row >> shift) & 1
            zeros = count - int(bit.sum())
            self.bits.append((shift, Bits(bit), zeros))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.base = np.zeros(1 << self.levels, dtype=np.int64)
        heads = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
        self.base[row[heads]] = heads
        sampled = (order - starts[run[order]]) % sample == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows of ``symbol`` put before the suffixes up to ``row``, by wavelet ranks."""
        at = row
        for shift, bits, zeros in self.bits:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return self.first[symbol] + at - self.base[symbol]

    def before(self, row: np.ndarray) -> np.ndarray:
        """The symbol before each row's suffix, read off the wavelet tree."""
        at, symbol = row, np.zeros(len(row), dtype=np.int64)
        for shift, bits, zeros in self.bits:
            bit = bits.get(at).astype(np.int64)
            symbol |= bit << shift
            ones = bits.rank(at)
            at = np.where(bit, zeros + ones, at - ones)
        return symbol

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of every phrase (rows of a matrix, left-aligned); empty where absent.

        Symbols that the index never saw must be left out by the caller.
        """
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.zeros(len(phrases), dtype=np.int64)
        alive = np.flatnonzero(lengths > 0)
        symbol = phrases[alive, lengths[alive] - 1]
        low[alive], high[alive] = self.first[symbol], self.first[symbol + 1]
        for back in range(2, phrases.shape[1] + 1):
            alive = alive[(low[alive] < high[alive])]
            going = alive[lengths[alive] >= back]
            if not len(going):
                break
            symbol = phrases[going, lengths[going] - back]
            low[going] = self.step(symbol, low[going])
            high[going] = self.step(symbol, high[going])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled position and add the steps."""
        found = np.empty(len(rows), dtype=np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            hit = self.sampled.get(at).astype(bool)
            found[left[hit]] = self.positions[self.sampled.rank(at[hit])] + steps
            left, at = left[~hit], at[~hit]
            at = self.step(self.before(at), at)
            steps += 1
        return found
