"""Suffix array by linear grouping.

Phase 1 sorts suffixes into groups of equal Lyndon prefixes. Groups start as the first symbols; the highest one not yet looked at
is final, and every suffix that the nearest lower group to the left of one of its members points at has its own
prefix made longer by it: such suffixes move to a new group just above the one they were in, those hit more often
higher. Phase 2 writes the order: each suffix, once placed, places those that it ends the Lyndon prefix of. Nothing is
renamed and no suffix is sorted twice.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in ascending order; a shorter one stands before what it begins."""
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64)
    first_order = np.argsort(symbols, kind="stable")
    ordered = symbols[first_order]
    begins = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
    sizes = np.diff(np.append(begins, n))
    group_array, place_array, size_array = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    group_array[first_order] = np.repeat(begins, sizes)
    place_array[first_order] = np.arange(n)
    size_array[begins] = sizes
    # plain lists are quicker one item at a time
    order, group, place, size = first_order.tolist(), group_array.tolist(), place_array.tolist(), size_array.tolist()
    lower = [-1] * n  # nearest place to the left whose group is lower
    end = n
    while end:
        start = group[order[end - 1]]
        if end - start == 1:
            i = order[start]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                _raise_to_end(j, order, group, place, size)
            end = start
            continue
        hits: dict[int, int] = {}
        for i in sorted(order[start:end]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        if hits:
            by_times: dict[int, dict[int, list[int]]] = {}
            for j, times in hits.items():
                by_times.setdefault(times, {}).setdefault(group[j], []).append(j)
            for times in sorted(by_times, reverse=True):
                for old, moved in by_times[times].items():
                    stop = old + size[old]
                    for j in moved:
                        stop -= 1
                        at, other = place[j], order[stop]
                        order[at], order[stop] = other, j
                        place[other], place[j] = at, stop
                    size[old] -= len(moved)
                    size[stop] = len(moved)
                    for j in moved:
                        group[j] = stop
        end = start
    made, free, placed = [0] * n, list(range(n)), [False] * n
    j = n - 1
    while j >= 0:
        made[free[group[j]]] = j
        free[group[j]] += 1
        placed[j] = True
        j = lower[j]
    for i in range(n):
        j = made[i] - 1
        while j >= 0 and not placed[j]:
            made[free[group[j]]] = j
            free[group[j]] += 1
            placed[j] = True
            j = lower[j]
    return np.array(made, dtype=np.int64)


def _raise_to_end(j: int, order: list[int], group: list[int], place: list[int], size: list[int]) -> None:
    """One suffix into a group of its own above the one it was in."""
    old = group[j]
    if size[old] == 1:
        return
    size[old] -= 1
    stop = old + size[old]
    at, other = place[j], order[stop]
    order[at], order[stop] = other, j
    place[other], place[j] = at, stop
    size[stop], group[j] = 1, stop
