"""Periodic runs of word sequences through a Re-Pair grammar, in numpy.

Many documents are handled at once; their words lie one document after another
and symbols are numbered within documents, so nothing crosses a document's end.
"""

from __future__ import annotations

import numpy as np

#: pairs of positions that are compared at a time
PAIRS = 2_000_000


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """Equal key tuples get equal numbers from 0."""
    out = np.unique(keys[0], return_inverse=True)[1].astype(np.int64)
    for k in keys[1:]:
        out = np.unique(out * (int(k.max(initial=0)) + 1) + k, return_inverse=True)[1].astype(np.int64)
    return out


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (owner, first + 0 .. count - 1) of every owner."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]


def repeating_documents(words: np.ndarray, bounds: np.ndarray, gram: int) -> np.ndarray:
    """Which documents hold some `gram` consecutive words twice (equal hashes count as equal words)."""
    n = len(words) - gram + 1
    found = np.zeros(len(bounds) - 1, bool)
    if n <= 0:
        return found
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, np.uint64)
    for k in range(gram):
        h = h * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + n]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.flatnonzero(doc[:n] == doc[gram - 1:])
    h, d = h[inside], doc[inside]
    h = (h ^ (h >> np.uint64(31))) * (d.astype(np.uint64) * np.uint64(2) + np.uint64(1)) + d.astype(np.uint64)
    order = np.argsort(h, kind="stable")
    same = (h[order][1:] == h[order][:-1]) & (d[order][1:] == d[order][:-1])
    found[d[order][1:][same]] = True
    return found


def grammar(symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Re-Pair: pairs of symbols that a document holds twice or more become nonterminals until none is left.

    Each round replaces every pair where it is more frequent than the pairs that
    overlap it, so many pairs are replaced at a time and the most frequent one
    always is.  symbols are numbered within documents.  Returns (derived, rest):
    derived has a row (nonterminal, start, boundary, end) for each place of each
    nonterminal, rest a row (document, start, end) for each symbol that is left.
    """
    start = np.arange(len(symbols))
    end = start + 1
    fresh = int(symbols.max(initial=0)) + 1
    derived, rest = [], []
    while len(symbols):
        pair = symbols[:-1] * fresh + symbols[1:]
        pair[doc[:-1] != doc[1:]] = -1
        number, times = np.unique(pair, return_inverse=True, return_counts=True)[1:]
        weight = times[number]
        weight[pair < 0] = 0
        again = np.zeros(int(doc[-1]) + 1, bool)
        again[doc[:-1][weight > 1]] = True
        left = ~again[doc]
        rest.append(np.stack([doc[left], start[left], end[left]]))
        # the frequency decides, then the pair itself; equal neighbours are one pair that overlaps itself
        rank = np.where(weight > 1, weight * (len(times) + 1) + number + 1, 0)
        edge = np.flatnonzero(np.diff(rank, prepend=-1))
        size = np.diff(edge, append=len(rank))
        level = rank[edge]
        before, after = np.append(-1, level)[:-1], np.append(level, -1)[1:]
        peak = (level > before) & (level > after) & (level > 0)
        owner, at = _expand(edge[peak], (size[peak] + 1) // 2)
        at += at - edge[peak][owner]  # every second place
        if len(at):
            name = fresh + np.unique(pair[at], return_inverse=True)[1]
            derived.append(np.stack([name, start[at], start[at + 1], end[at + 1]]))
            symbols, end = symbols.copy(), end.copy()
            symbols[at], end[at] = name, end[at + 1]
            fresh = int(name.max()) + 1
            left[at + 1] = True
        keep = ~left
        symbols, doc, start, end = symbols[keep], doc[keep], start[keep], end[keep]
    return (np.concatenate(derived, axis=1) if derived else np.zeros((4, 0), np.int64),
            np.concatenate(rest, axis=1) if rest else np.zeros((3, 0), np.int64))


def _joined(rest: np.ndarray) -> np.ndarray:
    """Nodes (start, boundary, end) of a balanced tree over each document's remaining symbols."""
    order = np.lexsort((rest[1], rest[0]))
    doc, start, end = rest[:, order]
    nodes = []
    while len(doc):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        place = np.arange(len(doc)) - np.repeat(first, np.diff(first, append=len(doc)))
        odd = np.flatnonzero(place % 2 == 1)
        if not len(odd):
            break
        nodes.append(np.stack([start[odd - 1], start[odd], end[odd]]))
        end = end.copy()
        end[odd - 1] = end[odd]
        keep = place % 2 == 0
        doc, start, end = doc[keep], start[keep], end[keep]
    return np.concatenate(nodes, axis=1) if nodes else np.zeros((3, 0), np.int64)


class _Extensions:
    """How far two places agree forwards and backwards: numbers of all substrings of 1, 2, 4, ... words."""

    def __init__(self, symbols: np.ndarray, stop: np.ndarray):
        # a place whose substring leaves its document has a number that no other place has
        n = len(symbols)
        alone = -np.arange(1, n + 2)
        self.ranks = [np.append(symbols, alone[n:])]
        length = 1
        while True:
            now = self.ranks[-1]
            ok = np.flatnonzero(stop - np.arange(n) >= 2 * length)
            if not len(ok):
                break
            pairs = now[ok] * (int(now.max()) + 1) + now[ok + length]
            names, inverse = np.unique(pairs, return_inverse=True)
            if len(names) == len(ok):
                break
            up = alone.copy()
            up[ok] = inverse
            self.ranks.append(up)
            length *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            step = np.where(self.ranks[k][i] == self.ranks[k][j], 1 << k, 0)
            i += step
            j += step
            total += step
        return total

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """i < j: agreement of the substrings that end before i and before j."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a = i - (1 << k)
            step = np.where((a >= 0) & (self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(j - (1 << k), 0)]), 1 << k, 0)
            i -= step
            j -= step
            total += step
        return total


def _crossing(nodes: np.ndarray, reach: _Extensions, least: int, base: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the repetitions across each node's boundary, as far as the node goes.

    Words that are a period apart agree over max(period, least - period) places
    or more, at least `gram` of them on one side of the boundary: the other end
    of the period is found among the places with the same `gram` words.
    """
    s, b, e = nodes
    gram, n = max(1, (least + 1) // 4), len(base)
    name = base
    for k in range(1, gram):
        name = _numbered(name, np.append(base[k:], np.zeros(k, np.int64)))
    inside = np.flatnonzero(stop - np.arange(n) >= gram)
    order = inside[np.argsort(name[inside], kind="stable")]
    keys = name[order] * n + order
    found = []
    for back in (False, True):
        at = b - gram if back else b
        ok = np.flatnonzero((at >= s) & (at + gram <= e))
        first = np.searchsorted(keys, name[at[ok]] * n + s[ok])
        count = np.searchsorted(keys, name[at[ok]] * n + e[ok] - gram, "right") - first
        many = count > 1  # the boundary's own place is one of them
        ok, first, count = ok[many], first[many], count[many]
        cuts = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS, prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(ok))):
            owner, place = _expand(first[lo:hi], count[lo:hi])
            node, other = ok[lo:hi][owner], order[place] + (gram if back else 0)
            differs = other != b[node]
            node, other = node[differs], other[differs]
            i, j = np.minimum(other, b[node]), np.maximum(other, b[node])
            period = j - i
            ahead = np.minimum(reach.forward(i, j), e[node] - j)
            behind = np.minimum(reach.backward(i, j), i - s[node])
            good = ahead + behind >= np.maximum(period, least - period)
            found.append((node[good], (i - behind)[good], (j + ahead)[good], period[good]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one document and period that share a whole period become one; each keeps its smallest period."""
    order = np.lexsort((start, period, doc[start])) if len(start) else np.zeros(0, np.int64)
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    group = np.cumsum((np.diff(period, prepend=-1) != 0) | (np.diff(doc[start], prepend=-1) != 0))
    wide = int(end.max()) + 1
    far = np.maximum.accumulate(group * wide + end)
    fresh = np.append(True, (group[1:] != group[:-1]) | (start[1:] > far[:-1] - group[:-1] * wide - period[1:]))
    at = np.flatnonzero(fresh)
    end = np.maximum.reduceat(end, at)
    start, period = start[at], period[at]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    return start[once], end[once], period[once]


def periodic_runs(words: np.ndarray, bounds: np.ndarray, least: int = 12) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of length max(least, 2 * period) or more, by start, then period.

    words: word numbers of all documents; document d is words[bounds[d]:bounds[d + 1]].
    A run's period is its smallest.  Places are those in `words`.
    """
    none = (np.zeros(0, np.int64),) * 3
    gram = (least + 1) // 2  # words that a run of `least` words or more holds twice at least
    some = repeating_documents(words, bounds, gram)
    if not some.any():
        return none
    size = np.diff(bounds)[some]
    _, origin = _expand(bounds[:-1][some], size)
    doc = np.repeat(np.arange(len(size)), size)
    stop = np.repeat(np.cumsum(size), size)
    base = _numbered(doc, words[origin])
    derived, rest = grammar(base, doc)
    # a nonterminal's repetitions are computed at its first place and then moved to all its places
    by_name = np.argsort(derived[0], kind="stable")
    derived = derived[:, by_name]
    first = np.flatnonzero(np.diff(derived[0], prepend=-1))
    places = np.diff(first, append=derived.shape[1])
    tops = _joined(rest)
    nodes = np.concatenate([derived[1:, first], tops], axis=1)
    node, start, end, period = _crossing(nodes, _Extensions(base, stop), least, base, stop)
    copies = np.append(places, np.ones(tops.shape[1], np.int64))[node]
    row, place = _expand(np.append(first, np.zeros(tops.shape[1], np.int64))[node], copies)
    inner = node[row] < len(first)
    shift = np.zeros(len(row), np.int64)
    shift[inner] = derived[1][place[inner]] - nodes[0][node[row[inner]]]
    start, end, period = _maximal(start[row] + shift, end[row] + shift, period[row], doc)
    order = np.lexsort((period, origin[start]))
    return origin[start][order], (origin[end - 1] + 1)[order], period[order]
