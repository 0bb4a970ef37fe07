"""Suffix orders of many short texts at once, by linear grouping.

First all suffixes of a text are grouped by their first character. Groups are then taken from the highest to the lowest. Each suffix of the group in hand finds its
previous smaller suffix: the nearest one to its left whose group is lower, reached over the pointers that higher suffixes already have. The suffixes pointed at leave
their groups for new ones just above, apart by how many of the group point at them; what a group's members share then is their Lyndon prefix. When all groups have
been taken, the order is emitted from the left: each emitted suffix sends its left neighbour, and from there along the pointers, to the next place of their groups.
No names are given and nothing is sorted again.

Texts are independent, so one step deals with the highest group left of every text at once, in array operations.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    ends = np.cumsum(sizes)
    out = np.ones(ends[-1] if len(ends) else 0, np.int64)
    if not out.size:
        return out
    some = sizes > 0
    starts, sizes, ends = starts[some], sizes[some], ends[some]
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - starts[:-1] - sizes[:-1] + 1
    return np.cumsum(out)


def suffix_orders(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places in `codes` (texts laid end to end, codes of at least 0) in the order of the suffixes, text by text. A suffix that is the beginning of another comes first."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    # place 0 and the end of each text hold an end mark below all codes; the mark before a text is also the wall on its left
    texts = np.repeat(np.arange(lengths.size), lengths + 1)
    marks = np.cumsum(lengths + 1)
    base = marks - lengths  # slot of each text's own mark
    text = np.ones(total + lengths.size + 1, bool)
    text[0] = text[marks] = False
    symbol = np.zeros(text.size, np.int64)
    symbol[text] = codes.astype(np.int64) + 1
    key = texts * (int(symbol.max()) + 1) + symbol[1:]
    slots = np.concatenate([[0], np.argsort(key, kind="stable") + 1]).astype(np.int32)
    place = np.empty(text.size, np.int32)
    place[slots] = np.arange(text.size, dtype=np.int32)
    sorted_key = key[slots[1:] - 1]
    first = np.concatenate([[0], np.nonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))[0] + 1])
    size = np.zeros(text.size, np.int32)
    size[first] = np.diff(np.append(first, text.size))
    head = np.empty(text.size, np.int32)  # first slot of each suffix's group
    head[slots] = np.repeat(first, size[first])
    before = _group(slots, place, size, head, text, base, marks)
    order = _emit(before, head, text, base, marks)
    return _strip(order, texts, base)


def _strip(order: np.ndarray, texts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The emitted places without the marks, counted without them."""
    keep = np.ones(order.size, bool)
    keep[0] = keep[base] = False
    found = order[keep]
    return found - 1 - texts[found - 1]


def _group(slots, place, size, head, text, base, marks) -> np.ndarray:
    """Splits the groups from the highest to the lowest; gives every suffix's previous smaller one."""
    before = np.arange(-1, text.size - 1, dtype=np.int32)
    touched = np.zeros(text.size, bool)
    last, floor = marks.copy(), base
    while True:
        left = last > floor
        if not left.all():
            last, floor = last[left], floor[left]
        if not last.size:
            return before
        start = head[slots[last]]
        members = slots[_ranges(start, last - start + 1)]
        own = head[members]
        last = start - 1
        # over higher suffixes, and over members of the same group, to the nearest lower one
        to, todo = members - 1, np.arange(members.size)
        while True:
            high = head[to[todo]] >= own[todo]
            todo = todo[high]
            if not todo.size:
                break
            to[todo] = before[to[todo]]
            before[members[todo]] = to[todo]
        to = np.sort(to[text[to]])
        if not to.size:
            continue
        edge = np.nonzero(np.concatenate([[True], to[1:] != to[:-1]]))[0]
        count = np.diff(np.append(edge, to.size))
        found = to[edge]
        group = head[found]
        by = np.argsort(group * (int(count.max()) + 1) + count, kind="stable")
        found, group, count = found[by], group[by], count[by]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        at = np.nonzero(new)[0]
        many = np.diff(np.append(at, found.size))
        groups = group[at]
        floor_slot = groups + size[groups] - many  # the upper end of each group takes the suffixes that leave it
        target = _ranges(floor_slot, many)
        touched[found] = True
        there = slots[target]
        there = there[~touched[there]]
        touched[found] = False
        was = place[found]
        free = was[was < np.repeat(floor_slot, many)]
        slots[free], place[there] = there, free
        slots[target], place[found] = found, target
        size[groups] -= many
        cut = np.nonzero(new | np.concatenate([[True], count[1:] != count[:-1]]))[0]
        runs = np.diff(np.append(cut, found.size))
        size[target[cut]] = runs
        head[found] = np.repeat(target[cut], runs)


def _emit(before, head, text, base, marks) -> np.ndarray:
    """All suffixes, in order, by slot: each one sends its left neighbour and that one's previous smaller suffixes to their groups' next places."""
    order = np.zeros(text.size, np.int32)
    done = ~text
    order[base] = marks
    following = np.arange(text.size, dtype=np.int32)
    at, end, now = base.copy(), marks, marks - 1
    while at.size:
        go = ~done[now]
        put = now[go]
        group = head[put]
        slot = following[group]
        order[slot] = put
        following[group] = slot + 1
        done[put] = True
        now[go] = before[put]
        rest = np.nonzero(~go)[0]
        if rest.size:
            step = at[rest] + 1
            at[rest] = step
            over = step > end[rest]
            now[rest] = order[np.minimum(step, end[rest])] - 1
            if over.any():
                keep = at <= end
                at, end, now = at[keep], end[keep], now[keep]
    return order
