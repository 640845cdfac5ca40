"""Suffix arrays of many short strings at once, by linear grouping construction.

*Grouping.* Suffixes start in groups by first symbol. Groups are processed in descending
order; when one is, all its members leave the list of open positions, and a maximal row of
members that stand side by side in that list points at the open position before it, the
previous smaller suffix. That position's prefix takes the members' prefixes in, so positions
with more members after them form higher groups right above what is left of their own. In the
end a group holds the suffixes with one longest Lyndon prefix.

*Order.* A suffix's place in its group is that of the suffix right after its Lyndon prefix, the
next smaller one. So groups are filled in ascending order: each suffix whose place is known
appends those that end at it to their groups. Nothing is named anew.

Every string takes its own steps, but a step is one numpy pass over the current groups of all
strings, so a step's cost is that of its members.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of [start, end), range after range."""
    n = ends - starts
    return np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)


def _turns(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the rows of equal keys."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(sorted_keys)))


def lyndon_groups(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every position the first place of its group, and the length of its longest Lyndon prefix.

    ``symbols`` are strings one after another, string i at offsets[i] to offsets[i + 1]; places count like positions.
    """
    n = len(symbols)
    string = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((symbols, string))
    place = np.empty(n, np.int64)  # of each position
    place[order] = np.arange(n)
    starts, lengths = _turns(string[order] * (int(symbols.max(initial=0)) + 1) + symbols[order])
    first = np.empty(n, np.int64)  # of each position: first place of its group
    first[order] = np.repeat(starts, lengths)
    end = np.zeros(n + 1, np.int64)  # by a group's first place
    end[starts] = starts + lengths
    prefix = np.ones(n, np.int64)
    before, after = np.arange(-1, n), np.arange(1, n + 2)  # the list of open positions; index n takes what falls outside
    before[offsets[:-1]], after[offsets[1:] - 1] = -1, n
    moved = np.zeros(n, bool)
    top, low = offsets[1:].astype(np.int64), offsets[:-1].astype(np.int64)
    top, low = top[top > low], low[top > low]
    while len(top):
        bottom = first[order[top - 1]]
        members = np.sort(order[_ranges(bottom, top)])
        ahead = before[members]
        opens = np.ones(len(members), bool)
        opens[1:] = ahead[1:] != members[:-1]
        at = np.flatnonzero(opens)
        count = np.diff(np.append(at, len(members)))
        target, behind = ahead[at], after[members[at + count - 1]]
        after[target], before[behind] = behind, target  # -1 stands for the spare entry
        real = target >= 0
        target, count = target[real], count[real]
        if len(target):
            prefix[target] += count * prefix[members[at[real]]]
            own = first[target]
            by = np.lexsort((count, own))
            target, count, own = target[by], count[by], own[by]
            held, many = _turns(own)
            groups = own[held]
            ends = end[groups]
            goal = _ranges(ends - many, ends)
            moved[target] = True
            stays = order[goal]
            stays = stays[~moved[stays]]
            old = place[target]
            free = old[old < np.repeat(ends - many, many)]
            order[free], place[stays] = stays, free
            order[goal], place[target] = target, goal
            moved[target] = False
            end[groups] = ends - many
            split, size = _turns(own * (n + 1) + count)
            first[target] = np.repeat(goal[split], size)
            end[goal[split]] = goal[split] + size
        going = bottom > low
        top, low = bottom[going], low[going]
    return first, prefix


def suffix_arrays(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, string after string (a suffix ends with its string, and a prefix comes first)."""
    n = len(symbols)
    offsets = offsets.astype(np.int64)
    first, prefix = lyndon_groups(symbols, offsets)
    follows = np.arange(n) + prefix  # the next smaller suffix; the end of its string if there is none
    by = np.argsort(follows, kind="stable")
    begin = np.searchsorted(follows[by], np.arange(n + 2))
    begins, ends = begin[:-1].copy(), begin[1:].copy()
    # What follows a string's end is the next string's first position, which is no suffix of that string.
    used = offsets[1:][np.diff(offsets) > 0]
    roots = _ranges(begins[used], ends[used])
    begins[offsets[:-1].clip(max=n)], ends[offsets[:-1].clip(max=n)] = 0, 0
    group = np.sort(first)  # by place
    filled = np.zeros(n, np.int64)  # by a group's first place
    out = np.empty(n, np.int64)

    def append(nodes: np.ndarray) -> None:
        to = first[nodes]
        turn = np.argsort(to, kind="stable")
        at, many = _turns(to[turn])
        inside = np.arange(len(nodes)) - np.repeat(at, many)
        out[to[turn] + filled[to[turn]] + inside] = nodes[turn]
        filled[to[turn][at]] += many

    if n:
        append(by[roots])
    at, last = offsets[:-1], offsets[1:]
    at, last = at[last > at], last[last > at]
    while len(at):
        until = group[at] + filled[group[at]]
        nodes = out[_ranges(at, until)]
        children = by[_ranges(begins[nodes], ends[nodes])]
        if len(children):
            append(children)
        going = until < last
        at, last = until[going], last[going]
    return out
