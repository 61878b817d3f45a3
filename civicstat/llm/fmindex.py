"""A compressed full-text index of word sequences, in numpy.

The Burrows-Wheeler transform of the sequences is kept in a wavelet matrix:
one packed bit row per bit of the alphabet, with a count for every 64 bits.
Backward search extends matches of many queries to the left in step. Matches
are cut to ``window`` words: a match that grows longer gives up its last
word, which widens its interval to all suffixes that share their first
``window`` words. The smallest owner of each such interval is stored.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit row with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = int(len(bits) - bits.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class Wavelet:
    """Rank of any symbol of a sequence of numbers."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.shifts = list(range(max(1, int(size - 1).bit_length()) - 1, -1, -1))
        self.rows, s = [], symbols
        for shift in self.shifts:
            bit = (s >> shift) & 1
            self.rows.append(Bits(bit.astype(np.uint8)))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.start = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, row in zip(self.shifts, self.rows):
            ones = row.rank(i)
            i = np.where((c >> shift) & 1 == 1, row.zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each ``c`` occurs before position ``i``."""
        return self._down(c, i) - self.start[c]


class Index:
    """Of sequences of words (bytes), each with an owner."""

    def __init__(self, sequences: list[list[bytes]], owners: np.ndarray, window: int):
        self.window = window
        number: dict[bytes, int] = {}
        parts = [[number.setdefault(w, len(number) + 2) for w in s] for s in sequences]  # 0: the end, 1: between
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        text = np.ones(int((self.sizes + 1).sum()) + 1, np.int64)
        text[-1] = 0
        inside = np.repeat(self.starts, self.sizes) + np.arange(self.sizes.sum()) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        text[inside] = np.fromiter((x for p in parts for x in p), np.int64, int(self.sizes.sum()))
        self.text, n, self.size = text, len(text), len(number) + 2
        order, near = self._suffixes(text, window)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size))])
        self.bwt = Wavelet(text[order - 1], self.size)
        owner = np.repeat(owners, self.sizes + 1)
        owner = np.append(owner, np.iinfo(np.int64).max)[order]
        heads = np.flatnonzero(near)
        self.head = heads[np.cumsum(near) - 1]  # where each suffix's interval begins
        self.tail = np.append(heads[1:], n)[np.cumsum(near) - 1]
        self.least = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.append(heads, n)))

    @staticmethod
    def _suffixes(text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of all suffixes by doubling, and which differ from the one
        before within ``window`` symbols."""
        n, h = len(text), 1
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        half = rank if window == 1 else None
        half_h = 1
        while True:
            if h <= window:
                half, half_h = rank, h
            behind = np.zeros(n, np.int64)
            if h < n:
                behind[:n - h] = rank[h:] + 1
            key = rank * (n + 1) + behind
            order = np.argsort(key, kind="stable")
            k = key[order]
            new = np.concatenate([[True], k[1:] != k[:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            h *= 2
            if new.all():
                break
        # first ``window`` symbols are equal if two stretches of ``half_h`` that cover them are
        if h <= window:
            half, half_h = rank, h
        more = np.append(half, -1)[np.minimum(order + window - half_h, n)]
        own = half[order]
        near = np.ones(n, bool)
        near[1:] = (own[1:] != own[:-1]) | (more[1:] != more[:-1])
        return order, near

    def least_owners(self) -> tuple[np.ndarray, np.ndarray]:
        """For every window of every indexed sequence, one after another, the
        smallest owner of an equal window; and the number of windows of each.

        Sequences are read from their ends, all at once; the interval of a
        window follows from that of the window to its right.
        """
        counts = np.maximum(self.sizes - self.window + 1, 0)
        at = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        lo = np.zeros(len(counts), np.int64)
        hi = np.full(len(counts), len(self.text), np.int64)
        live = np.flatnonzero(counts)
        for step in range(int(self.sizes.max(initial=0))):
            live = live[self.sizes[live] > step]
            left = self.sizes[live] - 1 - step
            c = self.text[self.starts[live] + left]
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            first = self.before[c] + both[:len(c)]
            lo[live], hi[live] = first, self.before[c] + both[len(c):]
            if step + 1 >= self.window:
                lo[live], hi[live] = self.head[first], self.tail[first]
                out[at[live] + left] = self.least[first]
        return out, counts
