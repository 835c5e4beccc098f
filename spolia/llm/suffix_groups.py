"""Suffix sorting by grouping: suffixes are grouped by their Lyndon prefixes, then every group's order is read off.

Phase one takes the groups from the highest to the lowest.  For each suffix of a group it finds the nearest earlier
suffix of a lower group (its previous smaller one); those that are pointed at split off their groups as their direct
successors, apart by the number of pointers.  When all groups are done each suffix stands with those of the same longest
Lyndon prefix.  Phase two goes through the order from the smallest suffix on and places, along the pointers,
the suffixes that end where it begins.  Both take linear time in all but the sorting of a group's positions.
"""

from __future__ import annotations


def suffix_order(symbols: list[int]) -> list[int]:
    """Positions in the order of the suffixes that start there; the last symbol must be the only least one."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start, last = 0, None
    for k, p in enumerate(order):
        place[p] = k
        if symbols[p] != last:
            start, last = k, symbols[p]
        group[p] = start
        size[start] += 1

    smaller = [-1] * n
    top = n - 1
    while top >= 0:
        low = group[order[top]]
        if low == top:  # a group of one points at one suffix at most
            s = order[top]
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = smaller[p]
            smaller[s] = p
            top -= 1
            g = group[p]
            count = size[g]
            if p >= 0 and count > 1:
                end, at = g + count - 1, place[p]
                other = order[end]
                order[at], order[end] = other, p
                place[other], place[p] = at, end
                size[g], size[end], group[p] = count - 1, 1, end
            continue
        members = order[low : top + 1]
        members.sort()
        pointed: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        top = low - 1
        if not pointed:
            continue
        most = max(pointed.values())
        by_count = [list(pointed)] if most == 1 else [[] for _ in range(most)]
        if most > 1:
            for p, c in pointed.items():
                by_count[c - 1].append(p)
        for targets in reversed(by_count):
            moved: dict[int, int] = {}
            for p in targets:  # to the end of its group
                g = group[p]
                m = moved.get(g, 0)
                end = g + size[g] - 1 - m
                at, other = place[p], order[end]
                order[at], order[end] = other, p
                place[other], place[p] = at, end
                moved[g] = m + 1
            for g, m in moved.items():
                if m < size[g]:
                    fresh = g + size[g] - m
                    size[g] -= m
                    size[fresh] = m
                    for p in order[fresh : fresh + m]:
                        group[p] = fresh

    placed = [False] * n
    out = [0] * n
    out[0] = n - 1
    placed[n - 1] = True
    free = group[:]  # by the start of a group: its next free place
    for g in set(group):
        free[g] = g
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = smaller[p]
    return out
