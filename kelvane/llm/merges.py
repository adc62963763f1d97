"""Byte-pair merging with a heap of ranks over a doubly linked symbol list."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush


def merge(symbols: list, pairs: dict[tuple, tuple]) -> list:
    """Merge adjacent symbols until no pair has a rank; returns what is left.

    ``pairs`` maps two symbols to ``(rank, merged)``. The lowest rank merges
    first, the leftmost pair among equals. An entry whose symbols changed since
    it was pushed is stale and skipped.
    """
    get, heap = pairs.get, []
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        found = get(pair)
        if found is not None:
            heap.append((found[0], i, pair, found[1]))
    if not heap:
        return symbols
    heapify(heap)
    n = len(symbols)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        _, left, (a, b), merged = heappop(heap)
        right = following[left]
        if right >= n or symbols[left] != a or symbols[right] != b:
            continue
        symbols[left], symbols[right] = merged, None
        after, before = following[right], previous[left]
        following[left] = after
        if after < n:
            previous[after] = left
            pair = merged, symbols[after]
            found = get(pair)
            if found is not None:
                heappush(heap, (found[0], left, pair, found[1]))
        if before >= 0:
            pair = symbols[before], merged
            found = get(pair)
            if found is not None:
                heappush(heap, (found[0], before, pair, found[1]))
    return [s for s in symbols if s is not None]


class Memo(dict):
    """A dict that computes missing values and stays bounded by ``trim``."""

    def __init__(self, compute: Callable, limit: int) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= 64:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
