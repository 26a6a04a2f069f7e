"""A double-array trie over fixed-length symbol sequences, built and walked by numpy.

A state is a place in two arrays. The child of state ``s`` by digit ``d`` is the
place ``t = base[s] + d``, and exists if ``check[t] == s``. Symbols are spelled
as base-256 digits, so that no state has more than 256 children and tables stay
dense. All walkers move together: one step is a gather and a comparison.
"""

from __future__ import annotations

import numpy as np

RADIX = 256
# States with more children than this get a block of their own; the others fill gaps.
CROWDED = 8


def digits_of(top: int) -> int:
    """Digits that spell every symbol up to ``top``."""
    return max(1, (int(top).bit_length() + 7) // 8)


def spelled(symbols: np.ndarray, width: int) -> np.ndarray:
    """Digits of ``symbols``, most significant first: one row per symbol."""
    shifts = np.arange(width - 1, -1, -1, dtype=np.int64) * 8
    return ((symbols.astype(np.int64)[:, None] >> shifts) & (RADIX - 1)).astype(np.int32)


class DoubleArray:
    """``rows`` (n x length, unique) are sequences of digits; ``leaf`` of the
    place where row i ends is i, else -1."""

    def __init__(self, rows: np.ndarray) -> None:
        n, length = rows.shape
        node = np.zeros(n, dtype=np.int64)
        parents, digits, children = [], [], []
        made = 1
        for depth in range(length):
            edges, node = np.unique(node * RADIX + rows[:, depth], return_inverse=True)
            parents.append(edges // RADIX)
            digits.append(edges % RADIX)
            children.append(np.arange(len(edges)) + made)
            # nodes are numbered over all depths, parents by their place in the last
            node = node + made
            made += len(edges)
        self.place(np.concatenate(parents), np.concatenate(digits), np.concatenate(children), made)
        self.leaf = np.full(len(self.base), -1, dtype=np.int32)
        self.leaf[self.at[node]] = np.arange(n, dtype=np.int32)
        del self.at

    def place(self, parent: np.ndarray, digit: np.ndarray, child: np.ndarray, nodes: int) -> None:
        """Choose ``base`` of every node so that no two children share a place."""
        order = np.argsort(parent, kind="stable")
        parent, digit, child = parent[order], digit[order], child[order]
        owners, first, degree = np.unique(parent, return_index=True, return_counts=True)
        crowded = degree > CROWDED
        blocks = int(crowded.sum())
        size = max(1 + RADIX * blocks, 4 * len(parent)) + 2 * RADIX
        chosen = np.zeros(len(owners), dtype=np.int64)
        chosen[crowded] = 1 + RADIX * np.arange(blocks)
        edge_owner = np.repeat(np.arange(len(owners)), degree)
        taken = np.zeros(size, dtype=bool)
        taken[0] = True
        settled = crowded[edge_owner]
        taken[chosen[edge_owner[settled]] + digit[settled]] = True
        waiting, seed = np.flatnonzero(~crowded), np.random.default_rng(0)
        while len(waiting):
            guess = seed.integers(1, size - RADIX, len(waiting))
            counts = degree[waiting]
            starts = np.cumsum(counts) - counts
            edges = np.repeat(first[waiting] - starts, counts) + np.arange(counts.sum())
            spots = np.repeat(guess, counts) + digit[edges]
            sole = np.zeros(len(spots), dtype=bool)
            sole[np.unique(spots, return_index=True)[1]] = True
            free = np.logical_and.reduceat(sole & ~taken[spots], starts)
            chosen[waiting[free]] = guess[free]
            taken[spots[np.repeat(free, counts)]] = True
            waiting = waiting[~free]
        self.at = np.zeros(nodes, dtype=np.int64)
        self.at[child] = chosen[edge_owner] + digit
        self.base = np.zeros(size, dtype=np.int32)
        self.base[self.at[owners]] = chosen
        self.check = np.full(size, -1, dtype=np.int32)
        self.check[self.at[child]] = self.at[parent]

    def step(self, states: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places after one digit, and which walkers are still in the trie."""
        to = self.base[states] + digits
        return to, self.check[to] == states
