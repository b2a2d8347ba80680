"""FM-index over a shard of word numbers, in numpy: wavelet-matrix ranks, backward search of many
phrases at once, and occurrences located by sampled suffix positions.

The text is an array of symbols; 0 separates runs of words and ends the text. Separators compare by
position, so no comparison goes beyond the end of a run.
"""

from __future__ import annotations

import numpy as np

#: Every so many text positions (and every first word of a run) the suffix position is kept.
SAMPLE = 32


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    seps = int((text == 0).sum())
    sorted_text = text[order].astype(np.int64)
    sorted_text[seps:] += seps
    sorted_text[:seps] = np.arange(seps)  # separators by position
    starts = np.flatnonzero(np.concatenate(([True], sorted_text[1:] != sorted_text[:-1])))
    size = np.diff(np.concatenate((starts, [n])))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, size)
    open_ = order[np.repeat(size > 1, size)]
    k = 1
    while len(open_):
        key = rank[open_] * (n + 1) + rank[np.minimum(open_ + k, n - 1)]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = rank[open_]
        group = np.concatenate(([True], first[1:] != first[:-1]))
        at = np.arange(len(open_))
        start = at[new][np.cumsum(new) - 1]  # where the finer group begins
        start -= at[group][np.cumsum(group) - 1]  # within the group it was in
        rank[open_] = first + start
        size = np.diff(np.concatenate((np.flatnonzero(new), [len(open_)])))
        open_ = open_[np.repeat(size > 1, size)]
        k *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class Bits:
    """A bit vector with constant-time ranks."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Index of a text of symbols 1 .. sigma with separators 0, the last symbol being one."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(text)
        sa = suffix_array(text)
        last = text[sa - 1]  # the symbol in front; position 0 wraps to the closing separator
        self.n, self.levels = n, max(1, int(sigma).bit_length())
        counts = np.bincount(text, minlength=sigma + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))  # row where each symbol's suffixes start
        self.tree, self.zeros = [], []
        symbol = np.arange(sigma + 1)
        base = np.zeros(sigma + 1, np.int64)
        for level in reversed(range(self.levels)):
            bit = (last >> level & 1).astype(bool)
            tree, zeros = Bits(bit), int(n - bit.sum())
            ones = tree.rank(base)
            base = np.where(symbol >> level & 1, zeros + ones, base - ones)
            self.tree.append(tree)
            self.zeros.append(zeros)
            last = np.concatenate((last[~bit], last[bit]))
        self.base = base
        keep = (np.arange(n) % sample == 0) | (np.concatenate(([0], text[:-1])) == 0)
        kept = keep[sa]
        self.sampled, self.position = Bits(kept), sa[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each row of the last column."""
        for level, tree, zeros in zip(reversed(range(self.levels)), self.tree, self.zeros, strict=True):
            ones = tree.rank(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases of equal length (one a row), from their last word back."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for c in phrases.T[::-1]:
            c = c[live]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step to the symbol in front until a sampled row is met."""
        out = np.empty(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(live):
            here = rows[live]
            met = self.sampled.get(here)
            out[live[met]] = self.position[self.sampled.rank(here[met])] + steps
            live, here = live[~met], here[~met]
            symbol = np.zeros(len(here), np.int64)
            for level, tree, zeros in zip(reversed(range(self.levels)), self.tree, self.zeros, strict=True):
                bit = tree.get(here)
                ones = tree.rank(here)
                symbol |= bit.astype(np.int64) << level
                here = np.where(bit, zeros + ones, here - ones)
            rows[live] = self.first[symbol] + here - self.base[symbol]
            steps += 1
        return out
