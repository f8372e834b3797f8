"""Linear suffix sorting by grouping.

Suffixes are first grouped by the longest Lyndon word they begin with: groups go
in descending order, and each sends its members' previous-smaller pointers
(the nearest place to the left in a lower group); the places pointed at are
regrouped by how many pointers they got.  Afterwards one ascending pass emits
each group's order.  No renaming, no recursion.
"""

from __future__ import annotations


def suffix_order(text: list[int]) -> list[int]:
    """Start places of the suffixes in order.  text ends with its only least symbol."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, i in enumerate(order):
        if text[i] != text[order[start]]:
            start = k
        place[i] = k
        group[i] = start
        size[start] += 1
    smaller = [-1] * n
    end = n - 1
    while end >= 0:
        start = group[order[end]]
        members = order[start : end + 1]
        if start != end:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:  # not lower: what lies between is known to be no lower either
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if len(pointed) == len(members):
            _regroup(pointed, order, place, group, size)
        else:
            by_count: dict[int, list[int]] = {}
            for j, c in pointed.items():
                by_count.setdefault(c, []).append(j)
            for c in sorted(by_count, reverse=True):
                _regroup(by_count[c], order, place, group, size)
        end = start - 1
    out = [-1] * n
    free = list(range(n))  # by group start: its first place not yet taken
    done = [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = smaller[j]
    return out


def _regroup(chosen, order: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Make of each group's chosen members a group of their own, just above it."""
    moved: dict[int, int] = {}
    for j in chosen:
        g = group[j]
        size[g] -= 1
        last = g + size[g]
        at, other = place[j], order[last]
        order[at], order[last] = other, j
        place[other], place[j] = at, last
        moved[g] = moved.get(g, 0) + 1
    for g, m in moved.items():
        new = g + size[g]
        size[new] = m
        if new != g:
            for k in range(new, new + m):
                group[order[k]] = new
