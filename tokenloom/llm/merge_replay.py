"""Merge replay over many distinct words at once, for the byte-pair operators.

All words' symbols lie in one chain.  An inverted index leads from each kind of
adjacent pair to the places where it stands; a pair's rank is looked up once
for the kind and set at all its places.  Merges go in rank order over all words,
each at all the places that its index entry holds: together where they are MANY,
can't overlap and make no pair of lower rank, else one after the other.  Only the pairs beside a merged one
are looked up and indexed anew.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np

SHIFT = 20  # symbol ids are below 2**20


NONE = 1 << 40  # stands for no rank
MANY = 24  # places of one pair that are merged together


def pair_key(a: int, b: int) -> int:
    return a << SHIFT | b


class Ranks:
    """The rank of each pair that merges, by pair_key."""

    def __init__(self, by_key: dict[int, int]):
        self.by_key = by_key
        order = sorted(by_key)
        self.keys = np.array(order, dtype=np.int64)
        self.values = np.array([by_key[k] for k in order], dtype=np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The ranks of the pairs (NONE: it does not merge), looked up by kind."""
        if not len(keys) or not len(self.keys):
            return np.full(len(keys), NONE)
        if len(keys) < 2000:  # few: looked up one by one
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            return np.where(self.keys[at] == keys, self.values[at], NONE)
        kinds, places = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)
        return np.where(self.keys[at] == kinds, self.values[at], NONE)[places]


def _pair_ranks(symbols: np.ndarray, ends: np.ndarray, ranks: Ranks) -> np.ndarray:
    """At each place, the rank of the pair it begins."""
    out = np.full(len(symbols), NONE)
    if len(symbols) > 1:
        out[:-1] = ranks.of(symbols[:-1] << SHIFT | symbols[1:])
    out[ends] = NONE
    return out


def _distinct(places: np.ndarray) -> np.ndarray:
    """Ascending, each once."""
    places.sort()
    return places[np.concatenate(([True], places[1:] != places[:-1]))] if len(places) else places


def replay(symbols: np.ndarray, lengths: np.ndarray, ranks: Ranks, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, lengths) of the words after all merges, lowest rank first, leftmost first.

    symbols: the words' ids (int64), one word after the other; lengths: ids of
    each word (1 at least); made: the id that the pair of a rank becomes.
    """
    n = len(symbols)
    ends = np.cumsum(lengths) - 1
    place = np.arange(n)
    syms, right, left = symbols.copy(), place + 1, place - 1
    right[ends] = -1
    left[ends + 1 - lengths] = -1
    pair = _pair_ranks(symbols, ends, ranks)
    index: dict[int, list[int]] = {}

    def enter(places: np.ndarray, found: np.ndarray) -> None:
        """Set the pairs at the places and index those that merge."""
        pair[places] = found
        held = np.flatnonzero(found < NONE)
        held = held[np.argsort(found[held], kind="stable")]
        kinds = found[held]
        first = np.flatnonzero(np.diff(kinds, prepend=-1))
        at = places[held].tolist()
        for q, a, b in zip(kinds[first].tolist(), first.tolist(), [*first[1:].tolist(), len(at)]):
            if q in index:
                index[q] += at[a:b]
            else:
                index[q] = at[a:b]
                heappush(order, q)

    order: list[int] = []
    enter(place, pair.copy())
    get = ranks.by_key.get
    # the same memory, read and written one number at a time
    sym_at, right_at, left_at, pair_at = map(memoryview, (syms, right, left, pair))
    while order:
        r = heappop(order)
        todo = index.pop(r)
        new = int(made[r])
        if len(todo) >= MANY:
            i = _distinct(np.array(todo))
            i = i[pair[i] == r]  # elsewhere a neighbour has changed since
            j = right[i]
            before, after = left[i], right[j]
            beside = np.concatenate([[new << SHIFT | new], syms[before[before >= 0]] << SHIFT | new, new << SHIFT | syms[after[after >= 0]]])
            # two places of such a pair never overlap
            if len(i) and syms[i[0]] != syms[j[0]] and ranks.of(beside).min() > r:
                syms[i], syms[j], pair[j], right[i] = new, -1, NONE, after
                inner = after >= 0
                left[after[inner]] = i[inner]
                before = left[i]
                touched = _distinct(np.concatenate([i, before[before >= 0]]))
                beside = right[touched]
                found = np.full(len(touched), NONE)
                has = beside >= 0
                found[has] = ranks.of(syms[touched[has]] << SHIFT | syms[beside[has]])
                enter(touched, found)
                continue
            todo = i.tolist()
        todo.sort()
        for k, i in enumerate(todo):
            if pair_at[i] != r:
                continue
            if order and order[0] < r:  # a merge has made a pair of lower rank: that goes first
                index[r] = todo[k:] + index.get(r, [])
                heappush(order, r)
                break
            j = right_at[i]
            after = right_at[i] = right_at[j]
            sym_at[i], sym_at[j], pair_at[j] = new, -1, NONE
            q = NONE
            if after >= 0:
                left_at[after] = i
                q = get(new << SHIFT | sym_at[after], NONE)
                if q < NONE:
                    if q in index:
                        index[q].append(i)
                    else:
                        index[q] = [i]
                        heappush(order, q)
            pair_at[i] = q
            before = left_at[i]
            if before >= 0:
                q = pair_at[before] = get(sym_at[before] << SHIFT | new, NONE)
                if q < NONE:
                    if q in index:
                        index[q].append(before)
                    else:
                        index[q] = [before]
                        heappush(order, q)
    kept = syms >= 0
    sizes = np.add.reduceat(kept, ends + 1 - lengths) if n else np.zeros(0, dtype=np.int64)
    return syms[kept], sizes.astype(np.int64)
