"""A compressed full-text index over words, and searches in it for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """The words of a sequence by the bits of their numbers, one packed bit vector per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = (sequence >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % 8 + 8)).view(np.uint64)
            self.words.append(packed)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]])
            self.zeros.append(len(bits) - int(bits.sum()))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for n, level in enumerate(reversed(range(self.levels))):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            below = self.words[n][word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = self.before[n][word] + np.bitwise_count(below)
            at = np.where(symbols >> level & 1, self.zeros[n] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` of the sequence."""
        return self._down(symbols, at) - self.start[symbols]


class FMIndex:
    """An index of texts given as arrays of word numbers from 1; 0 ends each text. Suffixes are sorted
    by their first ``depth`` words, so patterns of up to that many words can be searched."""

    def __init__(self, texts: list[np.ndarray], symbols: int, depth: int):
        self.sequence = np.concatenate([part for text in texts for part in (text, np.zeros(1, np.int64))])
        self.suffixes = self._sorted_suffixes(depth)
        self.places = np.empty_like(self.suffixes)
        self.places[self.suffixes] = np.arange(len(self.suffixes))
        self.first = np.r_[0, np.cumsum(np.bincount(self.sequence, minlength=symbols))]
        self.tree = WaveletTree(self.sequence[self.suffixes - 1], symbols)

    def _sorted_suffixes(self, depth: int) -> np.ndarray:
        n, width = len(self.sequence), 1
        order = np.argsort(self.sequence, kind="stable")
        while True:
            rank = np.empty(n, np.int64)
            keys = self.sequence if width == 1 else keys
            ordered = keys[order]
            rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
            if width >= depth:
                return order
            keys = rank * (n + 1) + np.r_[rank[width:] + 1, np.zeros(min(width, n), np.int64)]
            order = np.argsort(keys, kind="stable")
            width *= 2

    def search(self, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that begin with the ``size`` words at each of ``starts`` of the
        indexed sequence, by backward search: word by word from the last to the first. What is
        left with one suffix is at its own place, and is not searched on."""
        symbols = self.sequence[starts + size - 1]
        low, high = self.first[symbols], self.first[symbols + 1]
        found_low, found_high = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        going = np.arange(len(starts))
        for at in range(size - 2, -1, -1):
            several = high - low > 1
            alone = going[~several]
            found_low[alone] = self.places[starts[alone]]
            found_high[alone] = found_low[alone] + 1
            going, low, high = going[several], low[several], high[several]
            symbols = self.sequence[starts[going] + at]
            low = self.first[symbols] + self.tree.rank(symbols, low)
            high = self.first[symbols] + self.tree.rank(symbols, high)
        found_low[going], found_high[going] = low, high
        return found_low, found_high


def first_owners(texts: list[list[bytes]], owners: np.ndarray, size: int) -> list[np.ndarray]:
    """For each run of ``size`` words of each text: the least owner of a text that holds this run."""
    numbers: dict[bytes, int] = {}
    coded = [np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in text), np.int64, len(text)) for text in texts]
    index = FMIndex(coded, len(numbers) + 1, size)
    lengths = np.array([len(text) for text in texts])
    begins = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    counts = np.maximum(0, lengths - size + 1)
    ends = np.cumsum(counts)
    starts = np.arange(ends[-1]) + np.repeat(begins - (ends - counts), counts)
    low, high = index.search(starts, size)
    owner_of_suffix = np.repeat(owners, lengths + 1)[index.suffixes]
    distinct, which = np.unique(low, return_inverse=True)
    bounds = np.empty(2 * len(distinct), np.int64)
    bounds[::2] = distinct
    bounds[1::2][which] = high
    padded = np.r_[owner_of_suffix, np.iinfo(np.int64).max]
    least = np.minimum.reduceat(padded, bounds)[::2]
    return np.split(least[which], ends[:-1])
