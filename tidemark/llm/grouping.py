"""Suffix arrays in linear time by grouping, for operator 10.

First phase: suffixes start in groups by first symbol.  Groups are taken in descending order;
when its turn comes, a group holds the suffixes that share one Lyndon prefix.  Each of its
suffixes points to the nearest suffix on its left in a lower group (the previous smaller
suffix).  The suffixes pointed to move to new groups right above their old ones, those with
more pointers higher.  Second phase: from the smallest suffix on, each suffix and the chain of
its previous smaller suffixes are put at the next free place of their groups.  No names are
given anew and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_OPEN = -2


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order; a shorter suffix comes before a longer one it begins."""
    n = len(symbols)
    if n == 0:
        return []
    codes = np.asarray(symbols)
    order = np.argsort(codes, kind="stable")
    firsts = np.flatnonzero(np.diff(codes[order], prepend=codes[order[0]] - 1))
    members: list[list[int]] = [part.tolist() for part in np.split(order, firsts[1:])]
    ranks = np.empty(n, np.int64)
    ranks[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, n)))
    group: list[int] = ranks.tolist()
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    above[-1] = -1
    previous, pointers = [_OPEN] * n, [0] * n
    final: list[list[int]] = []
    current = len(members) - 1
    while current >= 0:
        mine = [i for i in members[current] if group[i] == current]
        members[current] = ()
        if mine:
            if len(mine) > 1:
                mine.sort()
            final.append(mine)
            hit: list[int] = []
            for i in mine:
                j = i - 1
                while j >= 0 and previous[j] != _OPEN:
                    j = previous[j]
                previous[i] = j
                if j >= 0:
                    if pointers[j] == 0:
                        hit.append(j)
                    pointers[j] += 1
            if hit:
                if len(hit) > 1:
                    sets: dict[tuple[int, int], list[int]] = {}
                    for j in hit:
                        key = (-pointers[j], group[j])
                        if key in sets:
                            sets[key].append(j)
                        else:
                            sets[key] = [j]
                    moves = sorted(sets.items())
                else:
                    moves = [((0, group[hit[0]]), hit)]
                for (_, old), moved in moves:
                    new = len(members)
                    members.append(moved)
                    over = above[old]
                    below.append(old)
                    above.append(over)
                    above[old] = new
                    below[over] = new
                    for j in moved:
                        group[j] = new
                        pointers[j] = 0
        current = below[current]
    start, at = [0] * len(members), 0
    for mine in reversed(final):
        start[group[mine[0]]] = at
        at += len(mine)
    result, placed = [n] * n, [False] * n

    def place(j: int) -> None:
        while j >= 0 and not placed[j]:
            g = group[j]
            result[start[g]] = j
            start[g] += 1
            placed[j] = True
            j = previous[j]

    place(n - 1)
    for k in range(n):
        j = result[k] - 1
        if j >= 0 and not placed[j]:
            place(j)
    return result


def common_prefixes(symbols: Sequence[int], suffixes: Sequence[int]) -> list[int]:
    """Length of the common prefix of each suffix and the one before it in order; 0 for the first."""
    n = len(suffixes)
    before = [-1] * n
    for a, b in zip(suffixes, suffixes[1:]):
        before[b] = a
    longest, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        most = n - (i if i > j else j)
        while h < most and symbols[i + h] == symbols[j + h]:
            h += 1
        longest[i] = h
        if h:
            h -= 1
    return [longest[i] for i in suffixes]
