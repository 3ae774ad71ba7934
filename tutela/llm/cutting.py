"""Cutting-stock plan for a histogram of lengths, by column generation.

The linear program covers the demand of every length by as few sequences as possible. Its columns,
patterns of lengths that fit a sequence, are priced by a knapsack recursion over the capacity. The
basis holds one pattern for each length, so plan, tables and time depend on the capacity alone and
not on the number of documents.
"""

from __future__ import annotations

import numpy as np


def price(values: np.ndarray, lengths: np.ndarray, capacity: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """For each room up to the capacity, the best sum of values that fits and the length taken
    last for it (0: none)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    by_length = np.full(capacity + 1, -np.inf)
    by_length[lengths] = values
    for room in range(1, capacity + 1):
        worth = by_length[1:room + 1] + best[room - 1::-1]
        k = int(worth.argmax())
        if worth[k] > best[room - 1] + 1e-12:
            best[room], taken[room] = worth[k], k + 1
        else:
            best[room] = best[room - 1]
    return best, taken


def trace(first: int, taken: np.ndarray, index: np.ndarray, capacity: int, m: int) -> np.ndarray:
    """The best pattern that holds the length ``first``."""
    pattern, room = np.zeros(m), capacity - first
    pattern[index[first]] = 1
    while room > 0:
        if taken[room]:
            pattern[index[taken[room]]] += 1
            room -= taken[room]
        else:
            room -= 1
    return pattern


def relax(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
          together: int = 16, smooth: float = 0.7, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (columns) and how often each is used in the linear program.

    Demands may be exceeded, so prices of lengths are not negative. They are smoothed toward those
    of the best bound, which keeps them from swinging. One knapsack recursion prices the best
    pattern around every length; those that pay enter one after the other while they still pay.
    Ends when no pattern pays or the value is within ``gap`` of a lower bound: the material, or
    the value of prices scaled to be feasible (Farley).
    """
    m = len(lengths)
    columns = np.diag(capacity // lengths).astype(float)
    cost = np.ones(m)
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    index = np.zeros(capacity + 1, np.int64)
    index[lengths] = np.arange(m)
    least, center = float(lengths @ demand) / capacity, lengths / capacity

    def enter(pattern: np.ndarray, price_of: float) -> None:
        has = np.flatnonzero(pattern)
        step = inverse[:, has] @ pattern[has]
        ratio = np.full(m, np.inf)
        np.divide(used, step, out=ratio, where=step > 1e-9)
        leave = int(ratio.argmin())
        far = max(ratio[leave], 0.0)
        used[:] = np.maximum(used - far * step, 0)
        used[leave] = far
        pivot = inverse[leave] / step[leave]
        np.subtract(inverse, np.outer(step, pivot), out=inverse)
        inverse[leave] = pivot
        columns[:, leave], cost[leave] = pattern, price_of

    for _ in range(rounds * m):
        dual = cost @ inverse
        worst = int(dual.argmin())
        if dual[worst] < -1e-9:
            surplus = np.zeros(m)
            surplus[worst] = -1
            enter(surplus, 0.0)
            continue
        total = float(cost @ used)
        if total <= least * (1 + gap):
            break
        entered = 0
        for share in (smooth, 0.0):
            trial = share * center + (1 - share) * dual
            best, taken = price(trial, lengths, capacity)
            bound = float(trial @ demand) / max(best[capacity], 1.0)
            if bound > least:
                least, center = bound, trial / max(best[capacity], 1.0)
            around = trial + best[capacity - lengths]
            for k in np.argsort(-around, kind="stable")[:together]:
                pattern = trace(int(lengths[k]), taken, index, capacity, m)
                if (cost @ inverse) @ pattern > 1 + 1e-9:
                    enter(pattern, 1.0)
                    entered += 1
            if entered:
                break
        if not entered:
            break
    return columns * (cost > 0), used * (cost > 0)


def fill(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """What rounding leaves, longest first, each into the fullest sequence that has room."""
    open_by_room: dict[int, list[dict[int, int]]] = {}
    rooms = np.zeros(capacity + 1, np.int64)
    for k in np.argsort(-lengths):
        for _ in range(int(left[k])):
            size = int(lengths[k])
            fits = np.flatnonzero(rooms[size:])
            room = int(fits[0]) + size if len(fits) else capacity
            if len(fits):
                sequence = open_by_room[room].pop()
                rooms[room] -= 1
            else:
                sequence = {}
            sequence[size] = sequence.get(size, 0) + 1
            open_by_room.setdefault(room - size, []).append(sequence)
            rooms[room - size] += 1
    return [s for kept in open_by_room.values() for s in kept]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) patterns that use every piece of the histogram exactly once."""
    out = [(histogram[capacity], {capacity: 1})] if histogram.get(capacity) else []
    lengths = np.array(sorted(n for n in histogram if n < capacity and histogram[n] > 0), np.int64)
    if not len(lengths):
        return out
    demand = np.array([histogram[int(n)] for n in lengths], float)
    columns, used = relax(lengths, demand, capacity)
    left = demand.astype(np.int64)
    for k in np.argsort(-used, kind="stable"):
        pattern = columns[:, k].astype(np.int64)
        has = pattern > 0
        if not has.any():
            continue
        times = int(min(np.floor(used[k] + 1e-6), (left[has] // pattern[has]).min()))
        if times > 0:
            left -= times * pattern
            out.append((times, {int(n): int(c) for n, c in zip(lengths[has], pattern[has])}))
    for k in np.argsort(-(used - np.floor(used)), kind="stable"):  # round up what still fits
        pattern = columns[:, k].astype(np.int64)
        if used[k] > 1e-6 and pattern.any() and (left >= pattern).all() and lengths @ pattern > 0.99 * capacity:
            left -= pattern
            has = pattern > 0
            out.append((1, {int(n): int(c) for n, c in zip(lengths[has], pattern[has])}))
    return out + [(1, s) for s in fill(lengths, left, capacity)]


def slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset of the first piece)
    sorted by length and rank. The piece of rank r among those of its length lies in sequence
    first sequence + (r - first rank) div pieces, behind offset + (r - first rank) mod pieces
    times length."""
    rows, sequence, ranks = [], 0, {}
    for times, pattern in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            count = pattern[length]
            rank = ranks.get(length, 0)
            rows.append((length, rank, sequence, count, offset))
            ranks[length] = rank + times * count
            offset += count * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)
