"""Compressed FM-index of short token sequences: wavelet matrices, backward search, document lists."""

from __future__ import annotations

import numpy as np

from holdfast.llm.arrays import ragged


class WaveletMatrix:
    """Rank and counting on a sequence of small integers, one bit vector for each bit."""

    def __init__(self, values: np.ndarray, n_bits: int):
        self.n, self.n_bits, self.levels = len(values), n_bits, []
        rest = values
        for bit in range(n_bits - 1, -1, -1):
            ones = (rest >> bit) & 1 == 1
            packed = np.zeros((self.n + 64) // 64 * 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[: len(bits)] = bits
            words = packed.view(np.uint64)
            directory = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32)
            self.levels.append((words, directory, self.n - int(ones.sum())))
            rest = np.concatenate([rest[~ones], rest[ones]])

    @staticmethod
    def _ones(level: tuple, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        words, directory, _ = level
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return directory[word] + np.bitwise_count(words[word] & below)

    def rank(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        base = np.zeros(len(symbols), np.int64)
        for depth, level in enumerate(self.levels):
            set_bit = (symbols >> (self.n_bits - 1 - depth)) & 1 == 1
            ends = []
            for place in (base, low, high):
                ones = self._ones(level, place)
                ends.append(np.where(set_bit, level[2] + ones, place - ones))
            base, low, high = ends
        return low - base, high - base

    def count_below(self, low: np.ndarray, high: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """How many values of each range ``low:high`` are smaller than its limit."""
        found = np.zeros(len(limits), np.int64)
        for depth, level in enumerate(self.levels):
            set_bit = (limits >> (self.n_bits - 1 - depth)) & 1 == 1
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            found += np.where(set_bit, (high - ones_high) - (low - ones_low), 0)
            low = np.where(set_bit, level[2] + ones_low, low - ones_low)
            high = np.where(set_bit, level[2] + ones_high, high - ones_high)
        return found


class FMIndex:
    """Index of sequences of codes, each owned by a number; ``depth`` bounds the patterns.

    Sequences lie end to end with separators. Suffixes are ordered by their first ``depth``
    symbols or more, which is all that patterns of that length can tell apart.
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, owners: np.ndarray, depth: int):
        lengths = np.diff(first)
        self.alphabet, symbols = np.unique(codes, return_inverse=True)
        text = np.zeros(len(codes) + len(lengths) + 1, np.int64)
        self.places = ragged(first[:-1] + np.arange(len(lengths)), lengths)
        text[self.places] = symbols + 1
        owner = np.repeat(np.append(owners, 0), np.append(lengths + 1, 1)).astype(np.int64)
        order, rank = _suffix_order(text, depth)
        self.symbols = symbols + 1
        self.starts = np.searchsorted(text[order], np.arange(len(self.alphabet) + 2))
        self.bwt = WaveletMatrix(text[order - 1], max(1, int(len(self.alphabet)).bit_length()))
        self.owners = WaveletMatrix(owner[order], max(1, int(owner.max(initial=0)).bit_length()))
        self.n = len(text)

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the patterns with one more symbol in front."""
        before, upto = self.bwt.rank(symbols, low, high)
        return self.starts[symbols] + before, self.starts[symbols] + upto

    def matching(self, ends: np.ndarray, owners: np.ndarray, longest: int) -> np.ndarray:
        """Matching statistics: of the indexed symbols that end at each place, how many (up to
        ``longest``) also stand together in a sequence of a smaller owner."""
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        length, live = np.zeros(len(ends), np.int64), np.arange(len(ends))
        for k in range(longest):
            low, high = self.step(self.symbols[ends[live] - k], low, high)
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            more = self.owners.count_below(low, high, owners[live]) > 0
            live, low, high = live[more], low[more], high[more]
            length[live] = k + 1
            if not len(live):
                break
        return length


def _suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by ``depth`` symbols or more, by doubling; and their ranks."""
    n, rank, known = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while known < depth:
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.zeros(n, np.int64)
        fresh[1:] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        known *= 2
    return order, rank
