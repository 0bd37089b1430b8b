"""Linear grouping suffix sorting of many short strings side by side.

Suffixes start in groups by first symbol. Groups are taken from the highest down: every member's pointer to its
nearest earlier suffix of a lower group is found by following the pointers of higher suffixes, and the suffixes
pointed at (their Lyndon prefix now continues with the group's) move to a new group at the top of their old one, those
pointed at by more members above the others. When all are done, groups hold suffixes of equal Lyndon prefix and the
pointers lead to each suffix's previous smaller one. The order then is emitted from the smallest suffix up: from
each emitted suffix the chain of pointers that starts just before it fills the next free places of its groups.
Nothing is renamed or sorted recursively. A group's number is its first place in the order, so numbers keep groups
in order while they split; the numpy steps take one group of every string (or one link of every chain) at a time.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of start..start + size - 1."""
    total = int(size.sum())
    before = np.repeat(np.cumsum(size) - size, size)
    return np.arange(total) - before + np.repeat(start, size)


class _Groups:
    def __init__(self, symbols: np.ndarray, string: np.ndarray) -> None:
        n = len(symbols)
        self.place = np.lexsort((symbols, string))  # place -> suffix
        self.of = np.empty(n, np.int64)  # suffix -> place
        self.of[self.place] = np.arange(n)
        s, t = symbols[self.place], string[self.place]
        new = np.ones(n, bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        first = np.flatnonzero(new)
        self.size = np.zeros(n, np.int64)  # at a group's first place
        self.size[first] = np.diff(np.append(first, n))
        self.first_of_end = np.zeros(n, np.int64)  # a group's last place -> its first
        self.first_of_end[first + self.size[first] - 1] = first
        self.group = np.empty(n + 1, np.int64)  # suffix -> group; the entry after the last stands for "none"
        self.group[self.place] = np.repeat(first, self.size[first])
        self.group[n] = -1
        self.marked = np.zeros(n, bool)

    def raise_(self, suffixes: np.ndarray) -> None:
        """Move ``suffixes`` (distinct) to new groups at the top of their groups."""
        suffixes = suffixes[np.argsort(self.group[suffixes], kind="stable")]
        old, k = np.unique(self.group[suffixes], return_counts=True)
        z = self.size[old]
        split = k < z
        if not split.any():
            return
        if not split.all():
            suffixes = suffixes[np.repeat(split, k)]
            old, k, z = old[split], k[split], z[split]
        top = old + z - k
        self.marked[suffixes] = True
        room = _ranges(top, k)
        leave = room[~self.marked[self.place[room]]]
        come = suffixes[self.of[suffixes] < np.repeat(top, k)]
        self.marked[suffixes] = False
        out, to = self.place[leave], self.of[come]
        self.place[leave], self.of[come] = come, leave
        self.place[to], self.of[out] = out, to
        self.size[old], self.size[top] = z - k, k
        self.first_of_end[top - 1], self.first_of_end[top + k - 1] = old, top
        self.group[suffixes] = np.repeat(top, k)


def suffix_orders(symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Suffix arrays of strings laid end to end: string k is symbols[start[k]:start[k + 1]] and none is empty. The
    result holds, over the same places, the string's suffixes (as positions in ``symbols``) in ascending order; a
    suffix that is a prefix of another comes first."""
    n = len(symbols)
    first, length = start[:-1], np.diff(start)
    groups = _Groups(symbols, np.repeat(np.arange(len(first)), length))
    group, none = groups.group, n
    before = np.arange(n) - 1
    before[first] = none
    prev = np.full(n + 1, none)

    end, left = first + length - 1, first
    while len(end):
        low = groups.first_of_end[end]
        member = groups.place[_ranges(low, end - low + 1)]
        own, p = group[member], before[member]
        todo = np.flatnonzero(group[p] > own)
        while len(todo):  # higher suffixes have their pointers
            p[todo] = prev[p[todo]]
            todo = todo[group[p[todo]] > own[todo]]
        prev[member] = p
        todo = np.flatnonzero(group[p] == own)
        while len(todo):  # members before this one, then what they point at
            p[todo] = prev[p[todo]]
            prev[member[todo]] = p[todo]
            todo = todo[group[p[todo]] == own[todo]]
        target, count = np.unique(p[p != none], return_counts=True)
        while len(target):
            groups.raise_(target)
            more = count > 1
            target, count = target[more], count[more] - 1
        end = low - 1
        alive = end >= left
        end, left = end[alive], left[alive]

    order = np.empty(n, np.int64)
    placed = np.zeros(n + 1, bool)
    placed[none] = True
    free = np.arange(n)  # next free place of each group
    rank, stop, link = first - 1, first + length, first + length - 1  # the end of the string comes before all suffixes
    while len(link):
        stuck = placed[link]
        j = link[~stuck]
        g = group[j]
        order[free[g]] = j
        free[g] += 1
        placed[j] = True
        link[~stuck] = prev[j]
        if stuck.any():
            rank = rank + stuck
            if (done := rank >= stop).any():
                rank, stop, link, stuck = rank[~done], stop[~done], link[~done], stuck[~done]
            link[stuck] = before[order[rank[stuck]]]
    return order
