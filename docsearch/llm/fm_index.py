"""A compressed full-text index: Burrows-Wheeler transform in a wavelet matrix of packed bits.

The text is a set of sequences of numbers. Backward search runs for many
patterns at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        kept = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(kept)


class WaveletMatrix:
    """Number of times a symbol stands before a position, in one step for each bit."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels, self.zeros = [], []
        for bit in range(max(int(n_symbols - 1).bit_length(), 1) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            self.levels.append((bit, Bits(ones.astype(np.uint8))))
            self.zeros.append(int(len(ones) - ones.sum()))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        start = np.zeros(len(at), np.int64)
        for (bit, bits), zeros in zip(self.levels, self.zeros, strict=True):
            high = ((symbol >> bit) & 1).astype(bool)
            a, b = bits.rank(start), bits.rank(at)
            start, at = np.where(high, zeros + a, start - a), np.where(high, zeros + b, at - b)
        return at - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the sorted length until all differ."""
    n, width = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        differs = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = differs
        if n == 0 or differs[-1] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Index of sequences, given one after another with their ends."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, n_symbols: int):
        """``symbols`` from 0 to n_symbols - 1; each sequence is followed by a separator."""
        n_separators = len(ends)
        text = np.insert(symbols.astype(np.int64) + n_separators, ends, np.arange(n_separators))
        order = suffix_array(text)
        before = text[order - 1]
        # All separators are one symbol in the index; they are never searched for.
        symbols_before = np.maximum(before - n_separators + 1, 0)
        self.tree = WaveletMatrix(symbols_before, n_symbols + 1)
        counts = np.bincount(symbols_before, minlength=n_symbols + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))

    def occurrences(self, symbol: np.ndarray) -> np.ndarray:
        return self.first[symbol + 2] - self.first[symbol + 1]

    def matching(self, symbols: np.ndarray, ends: np.ndarray, longest: np.ndarray,
                 least: int = 2) -> np.ndarray:
        """How far left of each end the text occurs at least ``least`` times, up to ``longest``."""
        found = np.zeros(len(ends), np.int64)
        lanes = np.arange(len(ends))
        low = np.zeros(len(ends), np.int64)
        high = np.full(len(ends), self.first[-1])
        while len(lanes):
            lanes = lanes[found[lanes] < longest[lanes]]
            symbol = symbols[ends[lanes] - 1 - found[lanes]] + 1
            both = self.tree.rank(np.concatenate((symbol, symbol)),
                                  np.concatenate((low[lanes], high[lanes])))
            low[lanes] = self.first[symbol] + both[:len(lanes)]
            high[lanes] = self.first[symbol] + both[len(lanes):]
            lanes = lanes[high[lanes] - low[lanes] >= least]
            found[lanes] += 1
        return found
