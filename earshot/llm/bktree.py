"""BK-trees over 64-bit fingerprints, many at once, in NumPy.

In a BK-tree every child hangs on its parent by an edge numbered with their Hamming distance. A
search within a radius follows, from a node at distance d, only edges d - radius to d + radius.
``Forest`` holds one tree per group; building and searching advance one level at a time for all
groups together, so thousands of small trees cost as little as one large one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS = 64
_FAN = BITS + 1
MAX_FRONTIER = 2_000_000


class Forest:
    def __init__(self, values: np.ndarray, groups: np.ndarray):
        """``groups`` numbers the tree of each value, equal numbers side by side."""
        self.values = values
        first = np.r_[True, groups[1:] != groups[:-1]]
        roots = np.flatnonzero(first)
        self.sizes = np.diff(np.r_[roots, len(values)])
        self.root = np.repeat(roots, self.sizes)
        keys, children = [], []
        moving = np.flatnonzero(~first)
        at = self.root[moving]
        while len(moving):
            key = at * _FAN + np.bitwise_count(values[moving] ^ values[at])
            order = np.argsort(key, kind="stable")
            moving, key = moving[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            keys.append(key[new])
            children.append(moving[new])
            at = moving[new][np.cumsum(new) - 1]
            moving, at = moving[~new], at[~new]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        self.children = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.children = self.keys[order], self.children[order]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of one tree and at most ``radius`` bits apart, in blocks."""
        reach = np.cumsum(np.repeat(self.sizes, self.sizes))  # no search visits more than its own tree
        start = 0
        while start < len(self.values):
            before = reach[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(reach, before + MAX_FRONTIER, "right")))
            query = np.arange(start, end)
            node = self.root[query]
            while len(query):
                distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
                near = (distance <= radius) & (query < node)
                if near.any():
                    yield query[near], node[near]
                low = np.searchsorted(self.keys, node * _FAN + np.maximum(distance - radius, 0))
                high = np.searchsorted(self.keys, node * _FAN + np.minimum(distance + radius, BITS), "right")
                n = high - low
                query = np.repeat(query, n)
                node = self.children[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(query))]
            start = end


class Unions:
    """Union-find over 0..n-1 that takes pairs by the array."""

    def __init__(self, n: int):
        self.roots = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        roots = self.roots
        low, high = np.minimum(roots[a], roots[b]), np.maximum(roots[a], roots[b])
        while (apart := low != high).any():
            low, high = low[apart], high[apart]
            np.minimum.at(roots, high, low)
            while not np.array_equal(up := roots[roots], roots):
                roots = up
            low, high = np.minimum(roots[low], roots[high]), np.maximum(roots[low], roots[high])
        self.roots = roots
