"""Bin completion over a histogram of lengths.

Equal lengths are interchangeable, so an instance is the number of pieces of each
length: at most ``capacity`` numbers, whatever the number of pieces. A node of the
search fills the bin of the largest length left. Its children come in two rounds:
a few promising fillings, each used as often as its lengths last, then, for one bin,
every filling that no other one dominates. A filling is dominated if a piece left
over fits beside it, or may take the place of one or two of its pieces that are no
larger together. The incumbent starts as best-fit decreasing. A node is cut if what
it wastes, or the bins that its remaining pieces need at least, leave no bin to save;
a filling that wastes more than is left to waste is not enumerated.

The search ends when the incumbent meets the lower bound, when all nodes are cut, or
after ``most_steps``; :class:`Packing` says which, beside the bound.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PROMISING = 4
MOST_STEPS = 400_000  # pieces tried in enumerations; a node counts as ``NODE_STEPS`` of them
NODE_STEPS = 100

Pattern = tuple[int, ...]


@dataclass(frozen=True)
class Packing:
    """Bin contents with multiplicities; ``proven`` if no packing can have fewer bins."""

    bins: list[tuple[Pattern, int]]
    used: int
    bound: int
    proven: bool


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[list(counts)] = list(counts.values())
    return _bound(left, capacity)


def _bound(left: np.ndarray, capacity: int) -> int:
    """For every size up to half a bin: pieces over half a bin, and what the pieces from
    that size up to half a bin need beyond the room that those leave them."""
    half = capacity // 2
    tokens = np.cumsum(left * np.arange(capacity + 1))
    number = np.cumsum(left)
    sizes = np.arange(half + 1)
    over_half = int(number[capacity] - number[half])
    # Pieces above capacity - size share with no piece of the size: no room in those bins.
    top = capacity - np.maximum(sizes, 1)
    top[0] = capacity
    shared = number[top] - number[half]
    room = shared * capacity - (tokens[top] - tokens[half])
    middle = tokens[half] - np.concatenate([[0], tokens[:half]])
    return over_half + int(max(0, (-(-(middle - room) // capacity)).max()))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing; bins with equal contents are one entry."""
    rooms: dict[int, list[list]] = {}
    order: list[int] = []
    full: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, times: int, room: int) -> None:
        if not times:
            return
        if not room:
            full.append((pattern, times))
            return
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append([pattern, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                put((length,) * each, left // each, capacity - each * length)
                put((length,) * (left % each), bool(left % each), capacity - left % each * length)
                break
            room = order[at]
            pattern, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                del order[at]
            used = min(left, times)
            put(pattern, times - used, room)
            put((*pattern, length), used, room - length)
            left -= used
    return full + [(pattern, times) for room in rooms.values() for pattern, times in room]


def promising(lengths: np.ndarray, counts: np.ndarray, room: int, keep: int) -> list[Pattern]:
    """Good fillings of ``room``, least waste and fewest pieces first.

    ``lengths`` ascend and all occur. One, two and three leading pieces are tried,
    each by the best partner for every first piece; what room is left is filled by
    the largest pieces that fit.
    """
    lengths = lengths[: np.searchsorted(lengths, room, "right")]
    if not len(lengths):
        return [()]
    found: dict[Pattern, int] = {}

    def add(*lead: int) -> None:
        chosen = Counter(lead)
        if any(n > counts[length] for length, n in chosen.items()):
            return
        rest = room - sum(lead)
        at = int(np.searchsorted(lengths, rest, "right")) - 1
        while at >= 0:
            length = int(lengths[at])
            take = min(rest // length, int(counts[length]) - chosen[length])
            if take > 0:
                chosen[length] += take
                rest -= take * length
            at = min(at, int(np.searchsorted(lengths, rest, "right"))) - 1
        found[tuple(sorted(chosen.elements(), reverse=True))] = rest

    add(int(lengths[-1]))
    if room - lengths[-1]:
        for lead, partner in _pairs(lengths, counts, room, keep):
            add(lead, partner)
        if min(found.values()):
            for first in lengths[::-1][:24]:
                for lead, partner in _pairs(lengths, counts, room - int(first), 1):
                    add(int(first), lead, partner)
    single = max((f[0] for f in found if len(f) == 1), default=0)
    ranked = sorted(found, key=lambda f: (found[f], len(f), tuple(-x for x in f)))
    return [f for f in ranked if len(f) == 1 or sum(f) > single][:keep]


def _pairs(lengths: np.ndarray, counts: np.ndarray, room: int, keep: int):
    """The fullest pairs, larger piece first."""
    lengths = lengths[: np.searchsorted(lengths, room, "right")]
    partner = np.searchsorted(lengths, room - lengths, "right") - 1
    first = np.flatnonzero(partner >= 0)
    if not len(first):
        return []
    first, second = lengths[first], lengths[partner[first]]
    fits = (second <= first) & ((second < first) | (counts[first] > 1))
    first, second = first[fits], second[fits]
    best = np.lexsort((-first, -(first + second)))[:keep]
    return [(int(first[i]), int(second[i])) for i in best]


class _Steps:
    """What is left of the work that a search may do."""

    def __init__(self, most: int):
        self.left = most

    def take(self, n: int = 1) -> bool:
        self.left -= n
        return self.left >= 0


def undominated(
    lengths: list[int], counts: np.ndarray, room: int, least: int, steps: _Steps
) -> Iterator[Pattern]:
    """Every filling of ``room`` by ``least`` or more that no other filling dominates.

    ``lengths`` descend. Ends early, without a filling, once the steps are spent.
    """
    rest = [0] * (len(lengths) + 1)  # all that the lengths from a place on could add
    for at in range(len(lengths) - 1, -1, -1):
        rest[at] = rest[at + 1] + lengths[at] * int(counts[lengths[at]])
    rising = lengths[::-1]
    chosen: list[int] = []

    def after(at: int, filled: int) -> Iterator[Pattern]:
        if filled >= least and not _dominated(chosen, rising, counts, room - filled):
            yield tuple(chosen)
        fitting = len(rising) - bisect_right(rising, room - filled)
        for k in range(max(at, fitting), len(lengths)):
            if filled + rest[k] < least or not steps.take():
                return
            for n in range(min((room - filled) // lengths[k], int(counts[lengths[k]])), 0, -1):
                chosen.extend([lengths[k]] * n)
                yield from after(k + 1, filled + n * lengths[k])
                del chosen[len(chosen) - n :]

    return after(0, 0)


def _dominated(chosen: list[int], rising: list[int], counts: np.ndarray, waste: int) -> bool:
    used = Counter(chosen)

    def spare(least: int, most: int) -> bool:
        at = bisect_left(rising, least)
        while at < len(rising) and rising[at] <= most:
            if counts[rising[at]] > used[rising[at]]:
                return True
            at += 1
        return False

    own = sorted(used)
    return (
        spare(1, waste)
        or any(spare(length + 1, length + waste) for length in own)
        or any(
            spare(a + b, a + b + waste)
            for i, a in enumerate(own)
            for b in own[i:]
            if a != b or used[a] > 1
        )
    )


def pack_histogram(
    counts: dict[int, int], capacity: int, most_steps: int = MOST_STEPS
) -> list[tuple[Pattern, int]]:
    """Bin contents and how many bins have them; every piece is in one of them."""
    return search(counts, capacity, most_steps).bins


def search(counts: dict[int, int], capacity: int, most_steps: int = MOST_STEPS) -> Packing:
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("every piece must fit a bin")
    counts = {length: n for length, n in counts.items() if n}
    if not counts:
        return Packing([], 0, 0, True)
    best = best_fit(counts, capacity)
    best_bins, bound = sum(times for _, times in best), lower_bound(counts, capacity)
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[list(counts)] = list(counts.values())
    tokens = int(sum(length * n for length, n in counts.items()))
    steps, turned = _Steps(most_steps), False
    path: list[tuple[Pattern, int]] = []
    open_nodes: list[Iterator[tuple[Pattern, int]]] = []
    used = 0

    def children() -> Iterator[tuple[Pattern, int]]:
        lengths = np.flatnonzero(left)
        largest = int(lengths[-1])
        left[largest] -= 1
        rest = lengths if left[largest] else lengths[:-1]
        good = [(largest, *f) for f in promising(rest, left, capacity - largest, PROMISING)]
        left[largest] += 1
        once = set()
        for pattern in good:
            times = min(int(left[length]) // n for length, n in Counter(pattern).items())
            if times == 1:
                once.add(pattern)
            yield pattern, times
        to_waste = (best_bins - 1 - used) * capacity - tokens
        left[largest] -= 1
        others, available = rest[::-1].tolist(), left.copy()
        left[largest] += 1
        room = capacity - largest
        for filling in undominated(others, available, room, room - to_waste, steps):
            pattern = (largest, *filling)
            if pattern not in once:
                yield pattern, 1

    while best_bins > bound:
        if turned and not steps.take(NODE_STEPS):
            return Packing(best, best_bins, bound, False)
        if not tokens:
            best, best_bins = list(path), used
            open_nodes.append(iter(()))
        elif used + _bound(left, capacity) >= best_bins:
            open_nodes.append(iter(()))
        else:
            open_nodes.append(children())
        while open_nodes:
            pattern, times = next(open_nodes[-1], ((), 0))
            if times:
                break
            open_nodes.pop()
            turned = True
            if path:
                pattern, times = path.pop()
                used -= times
                tokens += sum(pattern) * times
                for length in pattern:
                    left[length] += times
        if not open_nodes:
            return Packing(best, best_bins, bound, steps.left >= 0)
        for length in pattern:
            left[length] -= times
        tokens -= sum(pattern) * times
        used += times
        path.append((pattern, times))
    return Packing(best, best_bins, bound, True)
