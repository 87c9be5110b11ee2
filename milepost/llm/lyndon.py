"""Suffix array by Lyndon-prefix groups: linear construction without recursion."""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """The starts of all suffixes of ``symbols`` in lexicographic order.

    0 is the separator: it sorts before all else, and a suffix ends at the next one for the
    order's purpose, so suffixes equal up to a separator may stand in either order.

    First the suffixes are grouped by their longest Lyndon prefix. Groups are taken from the
    highest down. A member's previous-smaller pointer leads to the nearest earlier suffix of a
    lower group, found over the pointers of members already done. That suffix's prefix grows
    by the group's once for each member that points to it: it moves to a new group right above
    its own, above others that grew less. Then the order is emitted from the lowest suffix on:
    those that the emitted suffix ends take the next place in their groups.
    """
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {0: []}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    # Groups in order, as a list linked both ways; group 0 holds the separators.
    members = [by_symbol[c] for c in sorted(by_symbol)]
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1] = -1
    group = [0] * n
    for g, starts in enumerate(members):
        for i in starts:
            group[i] = g
    previous, done, ranked = [-1] * n, [False] * len(members), []
    top = len(members) - 1
    while top > 0:
        done[top] = True
        here = [i for i in members[top] if group[i] == top]
        if len(here) > 1:
            here.sort()  # pointers of earlier members are then known
        if here:
            ranked.append((top, len(here)))
        grown: dict[int, int] = {}
        for i in here:
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = previous[p]
            previous[i] = p
            if p >= 0 and group[p]:
                grown[p] = grown.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in grown.items():
            moved.setdefault((times, group[p]), []).append(p)
        # Each is put right above its old group, so the one that grew least comes last.
        for (_, g), starts in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
            new, high = len(members), above[g]
            members.append(starts)
            done.append(False)
            below.append(g)
            above.append(high)
            above[g] = below[high] = new
            for p in starts:
                group[p] = new
        top = below[top]

    order, placed = list(members[0]), [False] * n
    for i in order:
        placed[i] = True
    next_place, at = [0] * len(members), len(order)
    for g, size in reversed(ranked):
        next_place[g] = at
        at += size
    order += [-1] * (n - len(order))
    emitted = -1
    while emitted < n:
        # The end of the text sorts first, like a separator.
        i = n if emitted < 0 else order[emitted]
        p = i - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            order[next_place[g]] = p
            next_place[g] += 1
            placed[p] = True
            p = previous[p]
        emitted += 1
    return order
