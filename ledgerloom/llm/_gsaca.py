"""Suffix arrays by linear grouping (after Baier, "Linear-time Suffix Sorting", CPM 2016).

Suffixes are first grouped by their Lyndon prefixes: groups are taken in descending order, each group's suffixes point to
the nearest smaller group before them, and what they point to moves behind its own group, the further the more of the
group's suffixes point to it. Then the groups' order is emitted from the smallest suffix up, each suffix placing the
chain of previous-smaller pointers before it. Nothing is renamed or sorted again."""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes of ``text`` in order."""
    n = len(text)
    if not n:
        return []
    group, order, pos, end = _start_groups(text)
    prev = _refine(n, group, order, pos, end)
    return _emit(n, group, prev)


def _start_groups(text: bytes) -> tuple[list[int], list[int], list[int], list[int]]:
    """Groups of equal first bytes: a group is named by the place in ``order`` where it starts; end: one past its last."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    pos, group, end = [0] * n, [0] * n, [0] * n
    first = 0
    for i, s in enumerate(order):
        if text[s] != text[order[first]]:
            end[first] = i
            first = i
        pos[s], group[s] = i, first
    end[first] = n
    return group, order, pos, end


def _refine(n: int, group: list[int], order: list[int], pos: list[int], end: list[int]) -> list[int]:
    """Split groups down to equal Lyndon prefixes; returns each suffix's previous one of a smaller group, or -1."""
    prev = [-1] * n
    stop = n
    while stop:
        own = group[order[stop - 1]]
        if stop - own == 1:  # a group of one, as most are
            s = order[own]
            p = s - 1
            while p >= 0 and group[p] >= own:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                g = group[p]
                last = end[g] - 1
                if last > g:  # p leaves for a group of its own, behind the others
                    here = pos[p]
                    if here != last:
                        other = order[last]
                        order[here], order[last] = other, p
                        pos[other], pos[p] = here, last
                    end[g] = last
                    group[p], end[last] = last, last + 1
            stop = own
            continue
        times: dict[int, int] = {}
        for s in sorted(order[own:stop]):
            p = s - 1
            while p >= 0 and group[p] >= own:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        levels: dict[int, list[int]] = {}
        for p, k in times.items():
            levels.setdefault(k, []).append(p)
        for k in sorted(levels, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in levels[k]:
                moved.setdefault(group[p], []).append(p)
            for g, some in moved.items():
                tail = end[g]
                if tail - g == len(some):
                    continue  # all of it moves: nothing to split
                for p in some:
                    tail -= 1
                    here = pos[p]
                    if here != tail:
                        other = order[tail]
                        order[here], order[tail] = other, p
                        pos[other], pos[p] = here, tail
                end[tail] = end[g]
                end[g] = tail
                for p in some:
                    group[p] = tail
        stop = own
    return prev


def _emit(n: int, group: list[int], prev: list[int]) -> list[int]:
    """The suffixes in order: the empty one first, each placing the chain of suffixes before it that isn't placed yet."""
    out = [0] * n
    fill = list(range(n))
    placed = bytearray(n)
    p = n - 1
    while p >= 0 and not placed[p]:
        g = group[p]
        out[fill[g]] = p
        fill[g] += 1
        placed[p] = 1
        p = prev[p]
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[fill[g]] = p
            fill[g] += 1
            placed[p] = 1
            p = prev[p]
    return out
