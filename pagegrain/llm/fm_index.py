"""A compressed full-text index over sequences of words, searched for all queries of a batch at once.

Searches never look deeper than ``depth`` words, so suffixes are sorted by so many words only. The Burrows-Wheeler transform is kept as a
wavelet tree over packed bits (one bit row per level, ranks by block counts); the suffix array is not kept.
"""

from __future__ import annotations

import numpy as np

from pagegrain.llm.common import ship

ship(__name__)


class Bits:
    """Packed bits with ranks."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of ones among the first ``i`` bits."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Ranks of symbols; the nodes of a level lie one after the other, those of zero bits first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.shifts = range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1)
        self.levels, self.zeros = [], []
        for shift in self.shifts:
            bits = ((symbols >> shift) & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(sigma)
        #: where a symbol's node starts below the last level
        self.origin = self.walk(every, np.zeros(sigma, np.int64))

    def walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, level, zeros in zip(self.shifts, self.levels, self.zeros):
            ones = level.ones(i)
            i = np.where((c >> shift) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` stands among the first ``i`` symbols."""
        return self.walk(c, i) - self.origin[c]


class FMIndex:
    """Index of several sequences of words, given as 64-bit numbers one after the other with their lengths."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, depth: int):
        self.depth = depth
        self.alphabet, symbols = np.unique(words, return_inverse=True)
        ends = np.cumsum(lengths + 1) - 1
        self.size = int(len(words) + len(lengths))
        text = np.zeros(self.size, np.int64)  # symbol 0 ends a sequence
        inside = np.ones(self.size, bool)
        inside[ends] = False
        text[inside] = symbols + 1
        sigma = len(self.alphabet) + 1

        def paired(first: np.ndarray, second: np.ndarray, at: int) -> np.ndarray:
            moved = np.zeros_like(second)
            moved[:max(0, len(second) - at)] = second[at:]
            return np.unique(first * (second.max() + 1) + moved, return_inverse=True)[1]

        # ranks by the first 1, 2, 4, ... words; the rest of the depth by the ranks of a power of two
        ranks, done, kept = text, 1, {1: text}
        while done * 2 <= depth:
            ranks = paired(ranks, ranks, done)
            done *= 2
            kept[done] = ranks
        for power in sorted(kept, reverse=True):
            while done + power <= depth:
                ranks = paired(ranks, kept[power], done)
                done += power
        rows = np.argsort(ranks, kind="stable")
        # words that neighbouring rows have in common
        self.common = np.zeros(self.size, np.uint8)
        padded = np.concatenate([text, np.zeros(depth, np.int64)])
        same = np.ones(self.size - 1, bool)
        for k in range(depth):
            here = padded[rows + k]
            same &= (here[1:] == here[:-1]) & (here[1:] > 0)
            self.common[1:] += same
        self.starts: dict[int, np.ndarray] = {}
        self.count = np.searchsorted(text[rows], np.arange(sigma))
        self.tree = WaveletTree(text[rows - 1], sigma)
        self.rows = rows

    def least(self, values: np.ndarray) -> None:
        """Attaches a number to every word of the text, in the order given, and keeps the least of each full-depth interval only."""
        spread = np.full(self.size, np.iinfo(np.int64).max)
        spread[np.sort(self.rows[self.count[1]:])] = values
        starts = self.groups(self.depth)
        self.smallest = np.minimum.reduceat(spread[self.rows], starts)
        del self.rows

    def groups(self, k: int) -> np.ndarray:
        """First rows of the groups of suffixes that agree in ``k`` words."""
        if k not in self.starts:
            self.starts[k] = np.flatnonzero(self.common < k)
        return self.starts[k]

    def parent(self, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the first ``k`` words of these rows."""
        starts = self.groups(k)
        after = np.searchsorted(starts, row, side="right")
        return starts[after - 1], np.append(starts, self.size)[after]

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; -1 for what the index does not hold."""
        if not len(self.alphabet):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, -1)

    def statistics(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the queries: for each of their words, how many words from there on (``depth`` at most) occur
        together in the index, and the first row of their interval.

        Backward search, one step to the left in all queries at a time. What cannot be extended goes to the interval of one word less.
        """
        symbols = self.symbols(words)
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths)[order]
        sorted_lengths = lengths[order]
        low, high, size = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size), np.zeros(len(lengths), np.int64)
        found, rows = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for step in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(-sorted_lengths, -step))  # queries that are longer than the step
            at = ends[:n] - 1 - step
            c = symbols[at]
            lost = np.flatnonzero(c < 0)
            low[lost], high[lost], size[lost] = 0, self.size, 0
            open_ = np.flatnonzero(c >= 0)
            full = open_[size[open_] == self.depth]
            if len(full):
                low[full], high[full] = self.parent(low[full], self.depth - 1) if self.depth > 1 else (0, self.size)
                size[full] -= 1
            while len(open_):
                sym = c[open_]
                l, h = (self.count[sym] + self.tree.rank(sym, x[open_]) for x in (low, high))
                good = l < h
                hit = open_[good]
                low[hit], high[hit] = l[good], h[good]
                size[hit] += 1
                open_ = open_[~good]
                open_ = open_[size[open_] > 0]  # every symbol of the index extends the empty match
                for k in np.unique(size[open_]):
                    some = open_[size[open_] == k]
                    low[some], high[some] = self.parent(low[some], int(k) - 1) if k > 1 else (0, self.size)
                size[open_] -= 1
            found[at], rows[at] = size[:n], low[:n]
        return found, rows

    def smallest_at(self, rows: np.ndarray) -> np.ndarray:
        """The least attached number among the suffixes that agree in ``depth`` words with these rows."""
        return self.smallest[np.searchsorted(self.groups(self.depth), rows, side="right") - 1]
