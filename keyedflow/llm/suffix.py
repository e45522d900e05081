"""Suffix arrays by linear grouping, without recursive renaming.

Suffixes are grouped by their longest Lyndon prefix. Groups are processed in descending order: every member
points at the nearest suffix before it that lies in a lower group (its previous-smaller pointer), and that
suffix's prefix grows by the group's, so it moves into a new group just above its old one, further up the more
members point at it. When all groups are done, one ascending pass emits the order within each group: the
suffixes whose Lyndon prefix ends where an emitted suffix begins come next in their groups.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of all suffixes of ``text`` in order. Its last symbol has to be its only smallest one."""
    size = len(text)
    if not size:
        return []
    group_of, members, lower, upper, held = _first_symbols(text)
    previous = [-1] * size
    done = bytearray(size)
    current = len(members) - 1
    groups: list[list[int]] = []  # descending
    while current >= 0:
        group = [s for s in members[current] if group_of[s] == current]
        members[current] = ()
        if group:
            groups.append(group)
            for s in group:
                done[s] = 1
            pointed: list[int] = []
            times: list[int] = []
            last = -1
            for s in group:  # ascending, so pointers of members before s are known
                p = s - 1
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[s] = p
                if p >= 0:
                    if p == last:
                        times[-1] += 1
                    else:
                        pointed.append(p)
                        times.append(1)
                        last = p
            if pointed:
                _move_up(pointed, times, group_of, members, lower, upper, held)
        current = lower[current]
    return _emit(groups, previous, size)


def _first_symbols(text: list[int]):
    """Groups by first symbol, numbered and linked in ascending order."""
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    members: list = [by_symbol[symbol] for symbol in sorted(by_symbol)]
    group_of = [0] * len(text)
    for number, group in enumerate(members):
        for s in group:
            group_of[s] = number
    lower = list(range(-1, len(members) - 1))
    upper = [*range(1, len(members)), -1]
    return group_of, members, lower, upper, [len(group) for group in members]


def _move_up(pointed, times, group_of, members, lower, upper, held) -> None:
    """Move suffixes out of their groups into new ones above, by how often they were pointed at."""
    if len(pointed) == 1:
        p = pointed[0]
        if held[group_of[p]] > 1:
            _above(group_of[p], pointed, group_of, members, lower, upper, held)
        return
    parts: dict[int, dict[int, list[int]]] = {}
    for p, k in zip(pointed, times, strict=True):
        parts.setdefault(group_of[p], {}).setdefault(k, []).append(p)
    for old, by_times in parts.items():
        at = old
        for k in sorted(by_times):
            moved = by_times[k]
            # A group that moves as a whole keeps its place.
            if at != old or len(moved) < held[old]:
                at = _above(at, moved, group_of, members, lower, upper, held)


def _above(at, moved, group_of, members, lower, upper, held) -> int:
    """A new group right above ``at``, of members of one group; its number."""
    new = len(members)
    members.append(moved)
    held[group_of[moved[0]]] -= len(moved)
    held.append(len(moved))
    above = upper[at]
    lower.append(at)
    upper.append(above)
    upper[at] = new
    if above >= 0:
        lower[above] = new
    for s in moved:
        group_of[s] = new
    return new


def _emit(groups: list[list[int]], previous: list[int], size: int) -> list[int]:
    slot_of = [0] * size
    slots: list[int] = []
    start = 0
    for number, group in enumerate(reversed(groups)):
        for s in group:
            slot_of[s] = number
        slots.append(start)
        start += len(group)
    order = [-1] * size
    placed = bytearray(size)
    order[0] = size - 1
    placed[size - 1] = 1
    slots[0] += 1
    for i in range(size):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            number = slot_of[s]
            order[slots[number]] = s
            slots[number] += 1
            placed[s] = 1
            s = previous[s]
    return order
