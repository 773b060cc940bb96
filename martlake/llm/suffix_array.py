"""Linear suffix sorting by grouping (no recursion, no renaming).

Phase 1 sorts the suffixes into groups of equal longest Lyndon prefix.  Groups are taken in
descending order; each suffix of the group is linked to its previous smaller one (the nearest
suffix before it in a lower group, reached over the links made so far), and the suffixes so
linked grow their prefix by the group's, so they leave their group for a new one just above
it: those linked more often above those linked less often.

Phase 2 emits each group's order.  Suffixes with one Lyndon prefix are ordered by what
follows it, so going up the finished part of the array, the suffixes that end where the
current one begins (found over the links) take the next free places of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of an integer sequence (a proper prefix sorts before what it begins)."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    # suffixes by first symbol; a virtual end, smaller than all, stands at position n
    order_np = np.argsort(symbols, kind="stable")
    ranked = np.asarray(symbols)[order_np]
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[heads, n])
    start_np = np.empty(n, dtype=np.int64)
    start_np[order_np] = np.repeat(heads, sizes)
    place_np = np.empty(n, dtype=np.int64)
    place_np[order_np] = np.arange(n)
    order, place, start = order_np.tolist(), place_np.tolist(), start_np.tolist()
    size = [0] * n                       # of the group that starts there
    for h, s in zip(heads.tolist(), sizes.tolist()):
        size[h] = s
    prev = [-1] * n

    end = n
    while end > 0:
        head = start[order[end - 1]]
        if end - head == 1:
            s = order[head]
            p = s - 1
            while p >= 0 and start[p] >= head:
                p = prev[p]
            prev[s] = p
            if p >= 0:                   # one suffix leaves its group: the commonest case
                g = start[p]
                left = size[g] - 1
                if left:
                    size[g] = left
                    new = g + left
                    other, at = order[new], place[p]
                    order[at], place[other] = other, at
                    order[new], place[p] = p, new
                    start[p] = new
                    size[new] = 1
            end = head
            continue
        hits: dict[int, int] = {}
        for s in sorted(order[head:end]):
            p = s - 1
            while p >= 0 and start[p] >= head:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        if hits:
            levels: dict[int, dict[int, list[int]]] = {}
            for p, k in hits.items():
                levels.setdefault(k, {}).setdefault(start[p], []).append(p)
            for k in sorted(levels, reverse=True):
                for g, members in levels[k].items():
                    left = size[g]
                    for p in members:
                        left -= 1
                        other, at = order[left + g], place[p]
                        order[at], place[other] = other, at
                        order[left + g], place[p] = p, left + g
                    if left:
                        size[g] = left
                        new = g + left
                        size[new] = len(members)
                        for p in members:
                            start[p] = new
        end = head

    sa = [-1] * n
    free = list(range(n))                # next free place of the group that starts there
    done = bytearray(n)
    p = n - 1                            # what ends at the virtual end comes first
    while p >= 0 and not done[p]:
        g = start[p]
        sa[free[g]] = p
        free[g] += 1
        done[p] = 1
        p = prev[p]
    for i in range(n):
        p = sa[i] - 1
        while p >= 0 and not done[p]:
            g = start[p]
            sa[free[g]] = p
            free[g] += 1
            done[p] = 1
            p = prev[p]
    return np.array(sa, dtype=np.int64)
