"""A grouping genetic algorithm for packing lengths into bins of one capacity.

An individual is a list of bins.  Crossover injects whole well-filled bins of one
parent into the other, removes the bins that would hold an item twice and best-fits
the displaced items; mutation empties the worst and some random bins and best-fits their
items.  The first people of an island come from best-fit over noisy orders, and every search
runs at least one generation; it ends at the lower bound ceil(sum / capacity), or after
``generations``.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence


class Packing:
    """Bins with best-fit insertion: bins by residual capacity, and one bit for each residual that occurs."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.mask = 0

    def add_bin(self, items: list[int], room: int) -> None:
        b = len(self.bins)
        self.bins.append(items)
        self.room.append(room)
        if room in self.by_room:
            self.by_room[room].append(b)
        else:
            self.by_room[room] = [b]
            self.mask |= 1 << room

    def best_fit(self, items: list[int]) -> None:
        """Each item in turn into the fullest bin that holds it, else into a new one."""
        sizes, by_room, bins, room_of, mask = self.sizes, self.by_room, self.bins, self.room, self.mask
        for i in items:
            size = sizes[i]
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                held = by_room[room]
                b = held.pop()
                if not held:
                    del by_room[room]
                    mask ^= 1 << room
                bins[b].append(i)
                room -= size
                room_of[b] = room
            else:
                b, room = len(bins), self.capacity - size
                bins.append([i])
                room_of.append(room)
            if room in by_room:
                by_room[room].append(b)
            else:
                by_room[room] = [b]
                mask |= 1 << room
        self.mask = mask

    def quality(self) -> tuple[int, float]:
        """To be minimised: bins, then minus the mean squared fill."""
        c = self.capacity
        return len(self.bins), -sum([(c - r) * (c - r) for r in self.room]) / (c * c * max(1, len(self.bins)))


def best_fit_order(sizes: list[int], capacity: int, order: list[int]) -> Packing:
    p = Packing(sizes, capacity)
    p.best_fit(order)
    return p


def from_bins(sizes: list[int], capacity: int, bins: list[list[int]]) -> Packing:
    p = Packing(sizes, capacity)
    for b in bins:
        p.add_bin(list(b), capacity - sum(sizes[i] for i in b))
    return p


def _noisy(sizes: list[int], rng: random.Random, noise: float) -> list[int]:
    key = [s * rng.uniform(1 - noise, 1 + noise) for s in sizes]
    return sorted(range(len(sizes)), key=key.__getitem__, reverse=True)


def crossover(base: Packing, donor: Packing, rng: random.Random) -> Packing:
    full = sorted(range(len(donor.bins)), key=donor.room.__getitem__)
    take = full[: max(1, int(len(full) * rng.uniform(0.2, 0.6)))]
    taken = {i for b in take for i in donor.bins[b]}
    child, displaced = Packing(base.sizes, base.capacity), []
    for b in take:
        child.add_bin(list(donor.bins[b]), donor.room[b])
    for b, items in enumerate(base.bins):
        if taken.isdisjoint(items):
            child.add_bin(list(items), base.room[b])
        else:
            displaced += [i for i in items if i not in taken]
    displaced.sort(key=base.sizes.__getitem__, reverse=True)
    child.best_fit(displaced)
    return child


def mutate(parent: Packing, rng: random.Random) -> Packing:
    n = len(parent.bins)
    worst = sorted(range(n), key=parent.room.__getitem__, reverse=True)
    emptied = set(worst[: max(1, n // 50)]) | {rng.randrange(n) for _ in range(max(2, n // 20))}
    child, free = Packing(parent.sizes, parent.capacity), []
    for b, items in enumerate(parent.bins):
        if b in emptied:
            free += items
        else:
            child.add_bin(list(items), parent.room[b])
    key = {i: parent.sizes[i] * rng.uniform(0.8, 1.2) for i in free}
    free.sort(key=key.__getitem__, reverse=True)
    child.best_fit(free)
    return child


def evolve(sizes: list[int], capacity: int, seed: int, migrants: Sequence[list[list[int]]] = (), *, population: int = 5, generations: int = 8) -> tuple[list[list[int]], int]:
    """The best bins that one island finds, and how many generations it ran.

    Without ``migrants`` the island starts from noisy orders, the more noisy the later; with
    them from these and fresh people.
    """
    if not sizes:
        return [], 0
    rng = random.Random(seed)
    bound = math.ceil(sum(sizes) / capacity)
    people = [from_bins(sizes, capacity, m) for m in migrants]
    fresh = lambda noise: best_fit_order(sizes, capacity, _noisy(sizes, rng, rng.uniform(0, noise)))
    people += [fresh(0.1 * (1 + k)) for k in range(len(people), population)]
    people.sort(key=Packing.quality)
    for generation in range(1, generations + 1):
        a, (b, c) = people[0], rng.sample(people[1:], 2)
        people += [crossover(a, b, rng), crossover(c, a, rng), crossover(b, c, rng), mutate(a, rng), mutate(b, rng)]
        alive = {p.quality(): p for p in people}  # of those that look alike one stays, and newcomers take the others' places
        people = [alive[q] for q in sorted(alive)][:population]
        people += [fresh(1.0) for _ in range(len(people), population)]
        if len(people[0].bins) <= bound:
            break
    return people[0].bins, generation
