"""A bigram trie in Elias-Fano form, cut into shards by the context word's hash.

A shard is one file of arrays that a task maps into memory:
  words      hashes of the shard's words, Elias-Fano
  counts     each word's training count
  backoff    weight of the unigram model after the word, quantised
  pointers   where each word's successors begin, Elias-Fano
  successors for each word its successors' 40-bit ids, made monotone by the
             word's place, Elias-Fano
  gains      discounted bigram probabilities, quantised
"""

from __future__ import annotations

import io
import os
import tempfile

import numpy as np

from .fm_index import Bits

ID_BITS = 40  # of a successor; 64 - ID_BITS are left for the context's place in its shard
BINS, LOWEST = 65535, -12.0  # quantised log10 values lie in [LOWEST, 0]


def quantised(p: np.ndarray) -> np.ndarray:
    """Positive values up to 1 as bins of their log10."""
    return np.rint(np.clip(np.log10(np.maximum(p, 1e-300)) / LOWEST, 0, 1) * BINS).astype(np.uint16)


def restored(q: np.ndarray) -> np.ndarray:
    return 10.0 ** (q.astype(np.float64) * (LOWEST / BINS))


class EliasFano:
    """A monotone sequence below 2**bits: low bytes as they are, high parts in unary."""

    def __init__(self, low: np.ndarray, upper: Bits, n: int):
        self.low, self.upper, self.n = low, upper, n
        words = np.arange(len(upper.before), dtype=np.int64)
        self._zeros = words * 64 - upper.before
        self.shift = 8 * low.shape[1]

    @classmethod
    def of(cls, values: np.ndarray, bits: int) -> EliasFano:
        n = len(values)
        low_bytes = min(7, max(0, -(-(bits - max(n, 1).bit_length() + 1) // 8)))
        values = values.astype(np.uint64)
        low = np.empty((n, low_bytes), dtype=np.uint8)
        for k in range(low_bytes):
            low[:, k] = (values >> np.uint64(8 * k)) & np.uint64(255)
        high = (values >> np.uint64(8 * low_bytes)).astype(np.int64)
        unary = np.zeros(n + (int(high[-1]) if n else 0) + 2, dtype=np.uint8)
        unary[high + np.arange(n)] = 1
        return cls(low, Bits(unary), n)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one or zero (from 0)."""
        before = self.upper.before if ones else self._zeros
        w = np.searchsorted(before, k, side="right") - 1
        bits = self.upper.words[w] if ones else ~self.upper.words[w]
        left, at = (k - before[w]).astype(np.int64), np.zeros(len(k), dtype=np.uint64)
        for step in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count((bits >> at) & np.uint64((1 << step) - 1)).astype(np.int64)
            over = left >= here
            left -= np.where(over, here, 0)
            at += np.where(over, np.uint64(step), np.uint64(0))
        return w * 64 + at.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        rows, out = self.low[i], np.zeros(len(i), dtype=np.uint64)
        for k in range(rows.shape[1]):
            out |= rows[:, k].astype(np.uint64) << np.uint64(8 * k)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, True) - i
        return (high.astype(np.uint64) << np.uint64(self.shift)) | self._low(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, or -1: the first place not below it, in its high part's run."""
        out = np.full(len(values), -1, dtype=np.int64)
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        ask = np.flatnonzero(high < self.upper.zeros - 1) if self.n else np.zeros(0, dtype=np.int64)
        high, low = high[ask], values[ask] & np.uint64((1 << self.shift) - 1)
        lo = np.zeros(len(ask), dtype=np.int64)
        later = high > 0
        lo[later] = self._select(high[later] - 1, False) - (high[later] - 1)
        hi = self._select(high, False) - high
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        there = np.flatnonzero(lo < end)
        good = there[self._low(lo[there]) == low[there]]
        out[ask[good]] = lo[good]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.upper.words, self.upper.before, np.array([self.upper.zeros, self.n])]

    @classmethod
    def from_arrays(cls, a: list[np.ndarray]) -> EliasFano:
        upper = Bits.__new__(Bits)
        upper.words, upper.before, upper.zeros = a[1], a[2], int(a[3][0])
        return cls(a[0], upper, int(a[3][1]))


class Shard:
    """The trie of the words whose hash falls to one shard."""

    def __init__(self, arrays: list[np.ndarray], start: int, bits: int):
        self.start = np.uint64(start)
        self.words = EliasFano.from_arrays(arrays[0:4])
        self.counts, self.backoff = arrays[4], arrays[5]
        self.pointers = EliasFano.from_arrays(arrays[6:10])
        self.successors = EliasFano.from_arrays(arrays[10:14])
        self.gains = arrays[14]

    @staticmethod
    def build(words, counts, contexts, ids, pair_counts, start: int, bits: int, discount: float, least: int) -> list[np.ndarray]:
        """Arrays of a shard from its sorted words (counts 0: context only) and its sorted pairs (context, id)."""
        if len(words) >> (64 - ID_BITS):
            raise ValueError("too many words in a shard: use more shard bits")
        place = np.searchsorted(words, contexts)
        total = np.bincount(place, weights=pair_counts, minlength=len(words))
        stored = pair_counts >= least
        place, ids, pair_counts = place[stored], ids[stored], pair_counts[stored]
        gains = (pair_counts - discount) / total[place]
        rest = 1.0 - np.bincount(place, weights=gains, minlength=len(words))
        begin = np.searchsorted(place, np.arange(len(words) + 1))
        id_bits = max(len(words), 1).bit_length() + ID_BITS
        monotone = (place.astype(np.uint64) << np.uint64(ID_BITS)) | ids
        return [
            *EliasFano.of(words - np.uint64(start), bits).arrays(), counts.astype(np.int64), quantised(rest),
            *EliasFano.of(begin.astype(np.uint64), max(len(ids), 1).bit_length()).arrays(),
            *EliasFano.of(monotone, min(id_bits, 64)).arrays(), quantised(gains),
        ]

    def word(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place or -1, training count, backoff weight) of each word."""
        at = self.words.find(hashes - self.start)
        known = at >= 0
        counts, weight = np.zeros(len(at), dtype=np.int64), np.ones(len(at))
        counts[known] = self.counts[at[known]]
        weight[known] = restored(self.backoff[at[known]])
        return at, counts, weight

    def gain(self, places: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Discounted probability of successor id after the word at a place (0: not stored)."""
        out = np.zeros(len(places))
        lo, hi = self.pointers.get(places), self.pointers.get(places + 1)
        some = np.flatnonzero(lo < hi)
        at = self.successors.find((places[some].astype(np.uint64) << np.uint64(ID_BITS)) | ids[some])
        found = at >= 0
        out[some[found]] = restored(self.gains[at[found]])
        return out


def write_arrays(path: str, arrays: list[np.ndarray]) -> int:
    """One file of aligned arrays; a finished file appears under its name at once."""
    body, head = io.BytesIO(), []
    for a in arrays:
        body.write(b"\0" * (-body.tell() % 64))
        head.append(f"{a.dtype.str} {body.tell()} {','.join(map(str, a.shape))}")
        body.write(np.ascontiguousarray(a).tobytes())
    header = "\n".join(head).encode()
    data = len(header).to_bytes(8, "little") + header
    data += b"\0" * (-len(data) % 64) + body.getvalue()
    local = local_path(path)
    if local is None:
        from pyarrow import fs

        system, where = fs.FileSystem.from_uri(path)
        with system.open_output_stream(where) as f:
            f.write(data)
    else:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{os.getpid()}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, local)
    return len(data)


def read_arrays(path: str) -> list[np.ndarray]:
    """The arrays, mapped into memory; from a store without local paths a copy is mapped."""
    local = local_path(path)
    if local is None:
        from pyarrow import fs

        system, where = fs.FileSystem.from_uri(path)
        copy = tempfile.TemporaryFile()
        with system.open_input_stream(where) as f:
            while chunk := f.read(1 << 20):
                copy.write(chunk)
        copy.flush()
        data = np.memmap(copy, dtype=np.uint8, mode="r")
    else:
        data = np.memmap(local, dtype=np.uint8, mode="r")
    size = int.from_bytes(data[:8].tobytes(), "little")
    first = 8 + size + (-(8 + size) % 64)
    out = []
    for line in data[8 : 8 + size].tobytes().decode().split("\n"):
        dtype, at, shape = line.split(" ")
        dims = [int(x) for x in shape.split(",")]
        dtype = np.dtype(dtype)
        count = int(np.prod(dims))
        out.append(np.frombuffer(data, dtype=dtype, count=count, offset=first + int(at)).reshape(dims) if count else np.zeros(dims, dtype=dtype))
    return out


def local_path(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None
