"""Linear suffix sorting by grouping.

Phase 1 sorts suffixes into groups that share their longest Lyndon prefix. Groups start as first
symbols and are taken in descending order. Each suffix i of the group at hand looks up its previous
smaller suffix: the nearest one to its left that is in a lower group. That one's prefix is followed
by the group's word as often as it is named, so it leaves its group for a new one just above, the
higher the more often it was named.

Phase 2 emits the order: a suffix is its Lyndon prefix followed by the next smaller suffix, so going
through the order from the least suffix on, each emitted suffix puts those that it follows in the
next free place of their groups. Nothing is renamed and nothing recursive.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of all suffixes of `text` in ascending order. Symbols are integers; the last one must
    be smaller than all others."""
    n = len(text)
    if n == 0:
        return []
    symbols = sorted(set(text))
    number = {s: g for g, s in enumerate(symbols)}
    group = [number[s] for s in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(symbols)  # of the group's common prefix
    below = list(range(-1, len(symbols) - 1))
    above = [*range(1, len(symbols)), -1]
    nearest = list(range(n + 1))  # slot i + 1 leads to suffix i, or further left once i is done
    descending: list[int] = []
    at = len(symbols) - 1
    while at >= 0:
        mine = [i for i in members[at] if group[i] == at]
        members[at] = mine
        if mine:
            descending.append(at)
            for i in mine:
                nearest[i + 1] = i
            named: dict[int, int] = {}
            for i in mine:
                slot = i
                while nearest[slot] != slot:
                    nearest[slot] = slot = nearest[nearest[slot]]
                if slot:
                    named[slot - 1] = named.get(slot - 1, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in named.items():
                moved.setdefault((group[j], times), []).append(j)
            lower = split = -1
            for old, times in sorted(moved):
                if split != old:
                    lower = split = old
                new = len(members)
                members.append(moved[old, times])
                length.append(length[old] + times * length[at])
                upper = above[lower]
                below.append(lower)
                above.append(upper)
                above[lower] = new
                if upper >= 0:
                    below[upper] = new
                for j in members[new]:
                    group[j] = new
                lower = new
        at = below[at]

    free = [0] * len(members)
    filled = 0
    for g in reversed(descending):
        free[g] = filled
        filled += len(members[g])
    followed = [-1] * n  # first suffix whose next smaller suffix this is, then along `other`
    other = [-1] * n
    for i in range(n - 1):
        smaller = i + length[group[i]]
        other[i] = followed[smaller]
        followed[smaller] = i
    order = [n - 1] * n
    for s in range(n):
        i = followed[order[s]]
        while i >= 0:
            g = group[i]
            order[free[g]] = i
            free[g] += 1
            i = other[i]
    return order
