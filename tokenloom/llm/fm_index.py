"""FM-index of one training shard: suffix order, wavelet matrix, sampled positions (numpy)."""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every SAMPLE-th text position is stored


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Positions of s by suffix; s ends with its only 0.  Ranks triple their reach until all differ."""
    n = len(s)
    width = max(int(s.max()).bit_length(), 1)
    per = max(1, 62 // width)
    key, padded = np.zeros(n, dtype=np.int64), np.concatenate([s.astype(np.int64), np.zeros(per, dtype=np.int64)])
    for i in range(per):
        key = key << width | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    first = np.concatenate(([True], np.diff(key[order]) != 0))
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = starts + 1
    rank[n] = 0
    reach = per
    open_ = _tied(order, first)
    shift = int(n + 1).bit_length()
    while len(open_):
        a, b = np.minimum(open_ + reach, n), np.minimum(open_ + 2 * reach, n)
        old = rank[open_]
        key = (old << shift | rank[a]) << shift | rank[b] if 3 * shift <= 63 else old << shift | rank[a]
        by = np.argsort(key, kind="stable")
        key, old, open_ = key[by], old[by], open_[by]
        first = np.concatenate(([True], np.diff(key) != 0))
        group = np.concatenate(([True], np.diff(old) != 0))
        place = np.arange(len(by))
        rank[open_] = old + np.maximum.accumulate(np.where(first, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        reach *= 3 if 3 * shift <= 63 else 2
        open_ = _tied(open_, first)
    order = np.empty(n, dtype=np.int64)
    order[rank[:n] - 1] = np.arange(n)
    return order


def _tied(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The members of groups of two or more; first: marks each group's first place."""
    alone = first & np.concatenate((first[1:], [True]))
    return order[~alone]


class Bits:
    """A bit vector with rank: packed words and a count for each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int32)
        self.zeros = n - int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        w = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & below).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class FMIndex:
    """Backward search over symbols 1..top; the text may not hold 0."""

    def __init__(self, text: np.ndarray, top: int):
        s = np.concatenate([text, [0]]).astype(np.int32)
        order = suffix_order(s)
        n = self.n = len(s)
        bwt = s[order - 1]  # order 0 takes the last symbol, the 0
        self.start = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=top + 1))))
        self.levels: list[Bits] = []
        self.depth = max(int(top).bit_length(), 1)
        seq = bwt
        for level in range(self.depth - 1, -1, -1):
            bit = (seq >> level) & 1
            self.levels.append(Bits(bit))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.begin = self._descend(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))
        marked = order % SAMPLE == 0
        self.marks, self.samples = Bits(marked), order[marked].astype(np.int32)

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.levels):
            ones = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1, bits.zeros + ones, i - ones)
        return i

    def occurrences_before(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(c, i) - self.begin[c]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [from, to) of each pattern (a row, `lengths` symbols of it)."""
        rows = np.arange(len(patterns))
        c = patterns[rows, lengths - 1]
        lo, hi = self.start[c].copy(), self.start[c + 1].copy()
        for step in range(2, patterns.shape[1] + 1):
            going = np.flatnonzero((lo < hi) & (lengths >= step))
            if not len(going):
                continue
            c = patterns[going, lengths[going] - step]
            both = self.occurrences_before(np.concatenate([c, c]), np.concatenate([lo[going], hi[going]]))
            lo[going] = self.start[c] + both[: len(c)]
            hi[going] = self.start[c] + both[len(c) :]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a sampled one."""
        out, at, steps = np.zeros(len(rows), dtype=np.int64), rows.astype(np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            found = self.marks.get(at) == 1
            hit = at[found]
            out[left[found]] = self.samples[self.marks.rank(hit)] + steps
            left, at = left[~found], at[~found]
            c, i = np.zeros(len(at), dtype=np.int64), at
            for k, bits in enumerate(self.levels):
                bit = bits.get(i)
                ones = bits.rank(i)
                i = np.where(bit, bits.zeros + ones, i - ones)
                c |= bit << (self.depth - 1 - k)
            at = self.start[c] + i - self.begin[c]
            steps += 1
        return out
