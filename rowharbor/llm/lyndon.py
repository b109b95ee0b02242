"""Suffix arrays by grouping suffixes on their Lyndon prefixes, in linear time and without recursive renaming.

First the suffixes are grouped by first symbol. Groups are taken in descending order; each suffix of a group finds the nearest
earlier suffix of a smaller group (its previous-smaller pointer, followed along pointers already known), and the suffixes pointed
to are split off their groups, right behind what is left, those pointed to more often further behind. Each group then holds the suffixes of one
Lyndon prefix. In a second pass every suffix, taken in order, places its left neighbour and the neighbour's
chain of pointers at the next free place of their groups.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Positions of the suffixes of ``text`` in order. The last symbol must be the smallest and stand nowhere else."""
    n = len(text)
    if n == 0:
        return []
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    first = [0] * n  # by position: where the group starts
    size = [0] * n  # by start of a group
    start = 0
    for at, i in enumerate(order):
        place[i] = at
        if at and text[i] != text[order[at - 1]]:
            start = at
        first[i] = start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end:
        start = first[order[end - 1]]
        group = sorted(order[start:end])
        counts: dict[int, int] = {}
        for i in group:
            p = i - 1
            while p >= 0 and first[p] >= start:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if counts:
            if len(counts) == 1 or max(counts.values()) == 1:
                _split(counts, order, place, first, size)
            else:
                by_count: dict[int, list[int]] = {}
                for p, c in counts.items():
                    by_count.setdefault(c, []).append(p)
                for c in sorted(by_count, reverse=True):
                    _split(by_count[c], order, place, first, size)
        end = start
    return _emitted(n, first, smaller)


def _split(moved, order, place, first, size) -> None:
    """Move positions to new groups behind what is left of their own."""
    parts: dict[int, list[int]] = {}
    for p in moved:
        parts.setdefault(first[p], []).append(p)
    for start, part in parts.items():
        taken, whole = len(part), size[start]
        if taken == whole:
            continue
        tail = start + whole
        for p in part:
            tail -= 1
            other, at = order[tail], place[p]
            order[at], place[other] = other, at
            order[tail], place[p] = p, tail
        size[start] = whole - taken
        size[tail] = taken
        for p in part:
            first[p] = tail


def _emitted(n: int, first: list[int], smaller: list[int]) -> list[int]:
    free = list(range(n))  # by start of a group: its next free place
    out = [-1] * n
    done = [False] * n
    out[0] = n - 1
    done[n - 1] = True
    free[0] = 1
    for at in range(n):
        s = out[at] - 1
        while s >= 0 and not done[s]:
            group = first[s]
            out[free[group]] = s
            free[group] += 1
            done[s] = True
            s = smaller[s]
    return out
