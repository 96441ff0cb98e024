"""Suffix arrays of many texts at once by linear grouping on Lyndon prefixes.

Phase 1 keeps the suffixes of a text in groups by a common prefix, ordered by that prefix, and
takes the groups in descending order. The *previous smaller* suffix of a member is the nearest
one before it in a lower group; pointers of what has been done already are followed, so nothing
is compared. The prefix of a suffix so reached grows by the member's prefix, once for each
member that reached it: it moves, ordered by that number, to new groups at the upper end of its
own. In the end every suffix stands in the group of its longest Lyndon prefix. Phase 2 goes up
through the order: each suffix in its final place puts the suffix before it, and those its
pointers lead to, next in their groups. Nothing is renamed or sorted again.

A step of either phase is done for all texts of a batch side by side (one numpy lane each), so a
batch of many short texts costs few array operations per letter. Phase 2 ends the few longest
texts of a batch one by one.
"""

from __future__ import annotations

import numpy as np

#: Phase 2 goes on text by text once no more than these are left: a step over so few lanes costs more than its letters.
FEW = 32


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def suffix_arrays(letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffixes of each text ``bounds[i]:bounds[i + 1]`` in order, as positions in ``letters``.

    The last letter of each text must be lower than all its others.
    """
    n = len(letters)
    starts, stops = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), stops - starts)
    order = np.lexsort((letters, owner))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    head = np.ones(n, bool)
    head[1:] = (letters[order][1:] != letters[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    group = np.empty(n, np.int64)
    group[order] = first
    group_end = np.zeros(n + 1, np.int64)
    heads = np.flatnonzero(head)
    group_end[heads] = np.append(heads[1:], n)
    before = np.arange(n) - 1
    before[starts[starts < stops]] = -1

    top = stops.copy()
    lanes = np.flatnonzero(stops - starts > 1)
    while len(lanes):
        end = top[lanes]
        low = group[order[end - 1]]
        top[lanes] = low
        sizes = end - low
        member = order[_ragged(low, sizes)]
        own = np.repeat(low, sizes)
        reach = before[member]
        todo = np.flatnonzero(reach >= 0)
        todo = todo[group[reach[todo]] >= own[todo]]
        while len(todo):
            reach[todo] = before[reach[todo]]
            todo = todo[reach[todo] >= 0]
            todo = todo[group[reach[todo]] >= own[todo]]
        before[member] = reach
        reach = np.sort(reach[reach >= 0])
        if len(reach):
            new = np.flatnonzero(np.append(True, reach[1:] != reach[:-1]))
            times = np.diff(np.append(new, len(reach)))
            moved = reach[new]
            old = group[moved]
            by = np.lexsort((times, old))
            moved, times, old = moved[by], times[by], old[by]
            _move(moved, times, old, order, place, group, group_end)
        lanes = lanes[top[lanes] > starts[lanes] + 1]
    return _emit(starts, stops, group, before)


def _move(moved, times, old, order, place, group, group_end) -> None:
    """Put the moved suffixes, sorted by old group and times, into new groups at the ends of their old ones."""
    edge = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
    count = np.diff(np.append(edge, len(old)))
    groups = old[edge]
    slots = _ragged(group_end[groups] - count, count)
    from_ = place[moved]
    lower = np.repeat(group_end[groups] - count, count)
    there = order[slots]
    leaving = from_ < lower  # places outside the slots that become free
    if leaving.any():
        stays = np.zeros(len(slots), bool)
        stays[np.searchsorted(slots, from_[~leaving])] = True  # slots whose suffix moves itself
        pushed = there[~stays]
        free = from_[leaving]
        order[free] = pushed
        place[pushed] = free
    order[slots] = moved
    place[moved] = slots
    group_end[groups] -= count
    sub = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (times[1:] != times[:-1])))
    size = np.diff(np.append(sub, len(old)))
    group[moved] = np.repeat(slots[sub], size)
    group_end[slots[sub]] = slots[sub] + size


def _emit(starts: np.ndarray, stops: np.ndarray, group: np.ndarray, before: np.ndarray) -> np.ndarray:
    n = len(group)
    out = np.full(n, -1, np.int64)
    free = np.arange(n)
    placed = np.zeros(n, bool)
    lanes = np.flatnonzero(stops > starts)
    out[starts[lanes]] = stops[lanes] - 1
    placed[stops[lanes] - 1] = True
    lengths = stops - starts
    step = 0
    while len(lanes) > FEW:
        now = out[starts[lanes] + step]
        now = now[now > starts[lanes]] - 1
        now = now[~placed[now]]
        while len(now):
            at = free[group[now]]
            out[at] = now
            free[group[now]] += 1
            placed[now] = True
            now = before[now]
            now = now[now >= 0]
            now = now[~placed[now]]
        step += 1
        lanes = lanes[lengths[lanes] > step]
    for lane in lanes.tolist():
        low, high = int(starts[lane]), int(stops[lane])
        out[low:high] = _emit_one(*(x[low:high] for x in (out, group, before, free, placed)), step, low)
    return out


def _emit_one(out, group, before, free, placed, step: int, low: int) -> list[int]:
    """The rest of phase 2 for one text, whose arrays hold positions from ``low`` on."""
    out, group, before, free, placed = (x.tolist() for x in (out, group, before, free, placed))
    for i in range(step, len(out)):
        now = out[i] - low - 1
        while now >= 0 and not placed[now]:
            own = group[now] - low
            out[free[own] - low] = now + low
            free[own] += 1
            placed[now] = True
            now = before[now] - low
    return out
