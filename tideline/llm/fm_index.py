"""A compressed FM-index over integer symbols, searched backward for many windows at once."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A packed bit vector with a 32-bit count for every 64-bit word: half a bit of counts to each bit."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros((len(bits) >> 6) + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), dtype=np.uint32)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:], dtype=np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = at >> 6
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE))

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th one, from 0; k below the number of ones."""
        w = np.searchsorted(self.before, k, side="right") - 1
        rest, word, at = k - self.before[w].astype(np.int64), self.words[w], np.zeros(len(k), dtype=np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # into the half of the word that holds it
            low = np.bitwise_count(word & ((_ONE << np.uint64(width)) - _ONE)).astype(np.int64)
            up = rest >= low
            rest, at = np.where(up, rest - low, rest), np.where(up, at + width, at)
            word = np.where(up, word >> np.uint64(width), word)
        return w * 64 + at


class WaveletMatrix:
    """A wavelet tree in matrix form: a bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels, seq = [], symbols
        for bit in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((seq >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, Bits(bits), len(bits) - int(bits.sum())))
            seq = np.concatenate([seq[bits == 0], seq[bits == 1]])
        self.starts = self._walk(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbols >> bit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place `at`."""
        return self._walk(symbols, at) - self.starts[symbols]


class FMIndex:
    """Index of a text of symbols >= 1 in which 0 separates documents, for windows of `depth` symbols.

    It keeps the wavelet tree of the Burrows-Wheeler transform, where the symbols begin, a bit for each suffix whose common
    prefix with the one before is shorter than depth, and the sums of the weights (how often a place of the text counts) in
    the order of the suffixes. Neither the text nor its suffixes are kept: which windows are equal is known by search
    alone. Suffixes are sorted by at least depth + 1 symbols, which backward search over windows of that depth needs.
    """

    def __init__(self, text: np.ndarray, weights: np.ndarray, n_symbols: int, depth: int):
        n, self.depth = len(text), depth
        text = text.astype(np.int64)
        rank, width = text, 1

        def shifted(x: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate([x[by:], np.zeros(min(by, n), dtype=np.int64)])

        while 2 * width <= depth:
            rank = np.unique(rank * (int(rank.max()) + 1) + shifted(rank, width), return_inverse=True)[1]
            width *= 2
        key = rank * (int(rank.max()) + 1)
        order = np.argsort(key + shifted(rank, width), kind="stable")
        window = (key + shifted(rank, depth - width))[order]
        self.short = Bits(np.concatenate([np.concatenate([[True], window[1:] != window[:-1]])[:n], [True]]).astype(np.uint8))
        self.weight = np.concatenate([[0], np.cumsum(weights[order])])
        self.wavelet = WaveletMatrix(text[order - 1], n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.n, self.n_symbols = n, n_symbols

    def matches(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
        """Matching statistics at the threshold: for each place of text the weight of the index's windows equal to the one starting there.

        Documents text[starts[i]:ends[i]] are streamed from their ends, all at once, one symbol a step. An interval
        that reaches the full depth is narrowed by the next symbol and then widened to all suffixes that agree on the
        first `depth` symbols; one that becomes empty starts anew a symbol before its end. Places with no window have 0.
        begins, if given, receives where the interval of each place's window begins: a number that only equal windows share.
        """
        out, depth = np.zeros(len(text), dtype=np.int64), self.depth
        lanes = np.flatnonzero(ends - starts >= depth)
        low, at, size = starts[lanes], ends[lanes] - 1, np.zeros(len(lanes), dtype=np.int64)
        left, right = np.zeros(len(lanes), dtype=np.int64), np.full(len(lanes), self.n, dtype=np.int64)
        while len(low):
            c = text[at]
            known = (c > 0) & (c < self.n_symbols)
            c = np.where(known, c, 0)
            left, right = self.first[c] + self.wavelet.rank(c, left), self.first[c] + self.wavelet.rank(c, right)
            ok = known & (right > left)
            size = np.where(ok, size + 1, size)
            full = np.flatnonzero(ok & (size >= depth))
            if len(full):
                # The parent of the interval at full depth: all suffixes that agree on the first depth symbols.
                k = self.short.rank(left[full] + 1)
                left[full], right[full] = self.short.select(k - 1), self.short.select(k)
                size[full] = depth
                out[at[full]] = self.weight[right[full]] - self.weight[left[full]]
                if begins is not None:
                    begins[at[full]] = left[full]
            bad = ~ok
            at = np.where(ok, at - 1, at + size - 1)
            if bad.any():
                left[bad], right[bad] = 0, self.n
                size[bad] = 0
            # A lane is over when it has no symbol left, or too few for a window ending where it starts anew.
            on = (at >= low) & (at + size - low + 1 >= depth)
            if not on.all():
                low, at, size, left, right = low[on], at[on], size[on], left[on], right[on]
        return out
