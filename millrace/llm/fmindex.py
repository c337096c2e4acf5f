"""A compressed full-text index over a sequence of symbols, in numpy.

Suffix order by prefix doubling, the Burrows-Wheeler transform in a wavelet tree of packed
bits, and the longest common prefixes of neighbouring suffixes. Backward search over many
patterns at once gives matching statistics.
"""

from __future__ import annotations

import numpy as np


class Wavelet:
    """A wavelet tree, level by level: each keeps one bit per symbol and is sorted by that bit for the next."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]].astype(np.int32)
            self.levels.append((words, before, int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(sigma)
        self.first = self._down(every, np.zeros(sigma, dtype=np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, (words, before, zeros) in enumerate(self.levels):
            word = place >> 6
            mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & mask).astype(np.int64)
            is_one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            place = np.where(is_one, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, place) - self.first[symbol]


class FMIndex:
    """Index of a text of pieces of up to 62 symbols, each piece followed by symbol 0.

    ``weight`` says how many times each piece occurs; a match counts with the weights of
    the pieces it lies in. Suffixes are in the order of their first 64 symbols, which is
    all that patterns inside a piece can tell apart.
    """

    def __init__(self, text: np.ndarray, weight: np.ndarray):
        n = len(text)
        self.n, self.text = n, text
        sigma = int(text.max()) + 1 if n else 1
        rank = text.astype(np.int64)
        by_length = []  # ranks of the first 1, 2, 4 ... 32 symbols
        for h in (1, 2, 4, 8, 16, 32):
            by_length.append(rank.astype(np.int32))
            later = np.zeros(n, dtype=np.int64)
            later[: n - h] = rank[h:] + 1
            key = rank * (n + 2) + later
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]]) if n else 0
        suffix = order
        self.wavelet = Wavelet(text[suffix - 1].astype(np.int64), sigma)
        self.smaller = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))].astype(np.int64)
        self.weight = np.r_[0, np.cumsum(weight[suffix])]

        # common prefixes of neighbours, not beyond the end of a piece
        ends = np.flatnonzero(text == 0)
        left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        a, b, common = suffix[:-1].copy(), suffix[1:].copy(), np.zeros(max(0, n - 1), dtype=np.int64)
        for h, ranks in zip((32, 16, 8, 4, 2, 1), reversed(by_length)):
            same = (np.maximum(a, b) < n) & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
            step = np.where(same, h, 0)
            a, b, common = a + step, b + step, common + step
        common = np.minimum(common, left[suffix[:-1]])
        self.common = np.r_[-1, common, -1].astype(np.int8)
        # least common prefix of runs of 1, 2, 4 ... neighbours
        self.runs = [self.common]
        while 2 << len(self.runs) <= n:
            last, half = self.runs[-1], 1 << (len(self.runs) - 1)
            self.runs.append(np.minimum(last[:-half], last[half:]))

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes that start with the symbol before the match."""
        both = self.wavelet.rank(np.r_[symbol, symbol], np.r_[low, high])
        start = self.smaller[symbol]
        return start + both[: len(low)], start + both[len(low) :]

    def shorten(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Drop symbols at the end of the matches until more suffixes have them in common."""
        length = np.maximum(self.common[low], self.common[high]).astype(np.int64)
        length = np.maximum(length, 0)
        for level in range(len(self.runs) - 1, -1, -1):
            run, size = self.runs[level], 1 << level
            at = low - size + 1
            go = (at >= 0) & (run[np.maximum(at, 0)] >= length)
            low = np.where(go, low - size, low)
            go = (high < len(run)) & (run[np.minimum(high, len(run) - 1)] >= length)
            high = np.where(go, high + size, high)
        empty = length == 0
        return np.where(empty, 0, low), np.where(empty, self.n, high), length

    def matching(self, start: np.ndarray, length: np.ndarray, least: int, twice: int = 2) -> np.ndarray:
        """For pieces of the text: a bit for each place from which ``least`` symbols occur ``twice`` or more.

        All pieces are read from their ends at the same time. What is kept for each is the
        longest match that starts at its place and occurs often enough: it grows to the left
        as long as it does, and is shortened on the right where it does not.
        """
        found = np.zeros(len(start), dtype=np.int64)
        piece = np.arange(len(start))
        place = start + length - 1
        low, high, size = np.zeros(len(start), np.int64), np.full(len(start), self.n), np.zeros(len(start), np.int64)
        while len(piece):
            more_low, more_high = self.extend(low, high, self.text[place].astype(np.int64))
            often = self.weight[more_high] - self.weight[more_low] >= twice
            low, high, size = np.where(often, more_low, low), np.where(often, more_high, high), size + often
            hit = often & (size >= least)
            found[piece[hit]] |= np.int64(1) << (place[hit] - start[piece[hit]])
            failed = np.flatnonzero(~often & (size > 0))
            if len(failed):
                low[failed], high[failed], size[failed] = self.shorten(low[failed], high[failed])
            moved = np.ones(len(piece), dtype=bool)
            moved[failed] = False
            place = place - moved
            on = place >= start[piece]
            piece, place, low, high, size = piece[on], place[on], low[on], high[on], size[on]
        return found
