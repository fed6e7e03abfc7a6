"""A compressed FM-index over integer tokens: Burrows-Wheeler transform in a wavelet matrix of packed bits, sampled suffixes."""

from __future__ import annotations

import numpy as np

_LOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


def suffix_order(tokens: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in ascending order, by prefix doubling. All suffixes must differ."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: a level of packed bits for each bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels, self.size = [], len(symbols)
        self.base = np.zeros(most + 1, dtype=np.int64)  # where each symbol's run begins after the last level
        every, at = np.arange(most + 1), np.zeros(most + 1, dtype=np.int64)
        for bit in reversed(range(max(1, int(most).bit_length()))):
            ones = ((symbols >> bit) & 1).astype(np.uint8)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, dtype="<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32)
            level = (bit, words, before, int(len(ones) - ones.sum()))
            self.levels.append(level)
            at = self._down(level, every, at)
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        self.base = at

    @staticmethod
    def _down(level: tuple, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        bit, words, before, zeros = level
        word = at >> 6
        ones = before[word] + np.bitwise_count(words[word] & _LOW[at & 63])
        return np.where((symbols >> bit) & 1, zeros + ones, at - ones)

    def __len__(self) -> int:
        return self.size

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each pair, how often the symbol occurs before the place."""
        start = at
        for level in self.levels:
            start = self._down(level, symbols, start)
        return start - self.base[symbols]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for level in self.levels:
            bit, words = level[:2]
            symbols |= ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << bit
            at = self._down(level, symbols, at)
        return symbols, at - self.base[symbols]


class FMIndex:
    """Index of texts of positive tokens, one after another, each ended by a separator.

    It keeps the wavelet matrix of the transform and of every ``SAMPLED``th suffix which text it belongs to; the texts and the
    suffix order are dropped.
    """

    SAMPLED = 8

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        """``tokens``: the texts without separators; ``lengths``: of each text."""
        text, begins = separated(tokens, lengths)
        ends = begins + lengths
        # Separators sort before all tokens and differ from each other, so no match runs over one and no two suffixes tie.
        distinct = text + len(lengths)
        distinct[ends] = np.arange(len(lengths))
        order = suffix_order(distinct)
        most = int(text.max(initial=0))
        self.wavelet = WaveletMatrix(text[order - 1], most)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most + 1))])
        # A step back leads from a suffix to the one before it; every text's first suffix is sampled, so no step leaves a text.
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
        marked = ((np.arange(len(text)) - begins[owner]) % self.SAMPLED == 0)[order]
        self.marks = WaveletMatrix(marked.astype(np.int64), 1)
        self.owners = owner[order[marked]]

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of ``text`` (with separators) by backward search: length, low, high for each place in ``ends``.

        ``length`` is that of the longest run of tokens up to the place, ``most`` at most, which the index has at two places or
        more (a streamed text that is indexed itself has one of its own); [low, high) are the suffixes that begin with it.
        """
        length = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), len(self.marks), dtype=np.int64)
        alive = np.arange(len(ends))
        for step in range(most):
            alive = alive[ends[alive] >= step]
            symbol = text[ends[alive] - step]
            alive, symbol = alive[symbol > 0], symbol[symbol > 0]
            if not len(alive):
                break
            twice = np.tile(symbol, 2)
            both = self.first[twice] + self.wavelet.rank(twice, np.concatenate([low[alive], high[alive]]))
            lower, higher = np.split(both, 2)
            on = higher - lower > 1
            alive = alive[on]
            low[alive], high[alive], length[alive] = lower[on], higher[on], step + 1
        return length, low, high

    def texts(self, at: np.ndarray) -> np.ndarray:
        """The text that each suffix belongs to, by steps back to a sampled one."""
        at, out = at.copy(), np.zeros(len(at), dtype=np.int64)
        left = np.arange(len(at))
        while len(left):
            marked, before = self.marks.read(at[left])
            here = marked == 1
            out[left[here]] = self.owners[before[here]]
            left = left[~here]
            symbol, rank = self.wavelet.read(at[left])
            at[left] = self.first[symbol] + rank
        return out

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value (one per text) among the suffixes of each interval; the intervals are equal or disjoint."""
        starts, which = np.unique(low, return_inverse=True)
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        stops = np.zeros(len(starts), dtype=np.int64)
        stops[which] = high
        sizes = stops - starts
        begin = np.cumsum(sizes) - sizes
        every = np.repeat(starts - begin, sizes) + np.arange(sizes.sum())
        return np.minimum.reduceat(values[self.texts(every)], begin)[which]


def separated(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, each ended by a zero, and where each begins."""
    ends = np.cumsum(lengths + 1) - 1
    text = np.zeros(int(lengths.sum()) + len(lengths), dtype=np.int64)
    word = np.ones(len(text), dtype=bool)
    word[ends] = False
    text[word] = tokens
    return text, ends - lengths
