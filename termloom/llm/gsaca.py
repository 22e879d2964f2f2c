"""Suffix sorting by linear grouping over Lyndon prefixes.

Phase one sorts suffixes into groups by their longest Lyndon prefix. Groups start as
the single symbols and are taken in descending order: when a group is final, the nearest
smaller suffix to the left of each member (found through pointers over the finished
suffixes) has its own prefix extended by the group's, once per member that points to it, and
moves to a new group right above its old one. Phase two fills the array in ascending
order: a suffix is its Lyndon prefix and then the suffix behind it, so whenever a
suffix is placed, those that continue with it take the next free place of their groups.
No group is renamed and nothing is compared twice.
"""

from __future__ import annotations

from collections.abc import Sequence


def _groups(text: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(group of each suffix, prefix length of each group, groups in ascending order).

    Suffixes are numbered from 1; place 0 of the first list is not used.
    """
    n = len(text)
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text, 1):
        by_symbol.setdefault(symbol, []).append(i)
    members = [by_symbol[s] for s in sorted(by_symbol)]
    length = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    living = [len(m) for m in members]
    group = [0] * (n + 1)
    for g, found in enumerate(members):
        for i in found:
            group[i] = g
    # left[i] is i while suffix i is not final, else a place to the left of it.
    left = list(range(n + 1))
    order = []
    # A group knows the one above it only while that is needed: for insertion.
    upper = [*range(1, len(members)), -1]
    g = len(members) - 1
    while g >= 0:
        final = [i for i in members[g] if group[i] == g]
        members[g] = []
        if final:
            order.append(g)
            for i in final:
                left[i] = i - 1
            times: dict[int, int] = {}
            for i in final:
                p = i - 1
                while left[p] != p:
                    left[p] = left[left[p]]
                    p = left[p]
                if p:
                    times[p] = times.get(p, 0) + 1
            moved: dict[int, dict[int, list[int]]] = {}
            for p, count in times.items():
                moved.setdefault(group[p], {}).setdefault(count, []).append(p)
            for old, parts in moved.items():
                if len(parts) == 1:
                    ((count, found),) = parts.items()
                    if len(found) == living[old]:  # the whole group grows alike
                        length[old] += count * length[g]
                        continue
                below, above = old, upper[old]
                for count in sorted(parts):
                    found, new = parts[count], len(members)
                    for p in found:
                        group[p] = new
                    members.append(found)
                    living.append(len(found))
                    length.append(length[old] + count * length[g])
                    lower.append(below)
                    upper.append(above)
                    upper[below] = new
                    living[old] -= len(found)
                    below = new
                lower[above] = below
        g = lower[g]
    order.reverse()
    return group, length, order


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes in ascending order; a prefix sorts before what extends it."""
    n = len(text)
    if not n:
        return []
    group, length, order = _groups(text)
    size = [0] * len(length)
    for i in range(1, n + 1):
        size[group[i]] += 1
    free, start = [0] * len(length), 0
    for g in order:
        free[g] = start
        start += size[g]
    # Suffixes that continue with the same suffix, as chains.
    head, chain = [0] * (n + 2), [0] * (n + 1)
    for i in range(1, n + 1):
        behind = i + length[group[i]]
        chain[i] = head[behind]
        head[behind] = i
    array = [0] * n
    at, i = 0, head[n + 1]
    while True:
        while i:
            g = group[i]
            array[free[g]] = i
            free[g] += 1
            i = chain[i]
        if at == n:
            return [i - 1 for i in array]
        i = head[array[at]]
        at += 1
