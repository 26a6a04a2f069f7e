"""Best-fit-decreasing packing planned on the histogram of lengths.

What best fit does with a sequence depends on its length alone, and it fills a
block with as many equal sequences as fit before it turns to the next one. So
blocks with the same history are handled as one range, and a plan for any number
of sequences is computed from at most ``block`` counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple


class Placement(NamedTuple):
    """Sequences of ``length`` with ranks ``first_rank`` .. + ``count`` go, ``per_block``
    in each, into the blocks from ``first_block`` on, behind ``used`` tokens."""

    length: int
    first_rank: int
    count: int
    per_block: int
    first_block: int
    used: int


def best_fit_plan(histogram: Iterable[tuple[int, int]], block: int) -> list[Placement]:
    """Placements of all sequences of a histogram (length, count), lengths 1 to ``block``.

    Longest first, each into the fullest block with room for it; of blocks that
    are equally full, the one of the lowest number among the first range.
    """
    # ranges of blocks (first, how many) by their free space
    free: dict[int, list[tuple[int, int]]] = {}
    plan: list[Placement] = []
    opened = 0
    for length, count in sorted(histogram, reverse=True):
        if not 1 <= length <= block:
            raise ValueError(f"length {length} is not between 1 and {block}")
        rank = 0
        moved: list[tuple[int, int, int]] = []
        for space in sorted(s for s in free if s >= length):
            fit = space // length
            ranges = free.pop(space)
            while ranges and rank < count:
                first, n = ranges.pop(0)
                take = min(n * fit, count - rank)
                blocks, rest = divmod(take, fit)
                plan.append(Placement(length, rank, take, fit, first, block - space))
                rank += take
                if blocks:
                    moved.append((space - fit * length, first, blocks))
                if rest:
                    moved.append((space - rest * length, first + blocks, 1))
                if left := n - blocks - bool(rest):
                    ranges.insert(0, (first + blocks + bool(rest), left))
            if ranges:
                moved.extend((space, *r) for r in ranges)
            if rank == count:
                break
        if rank < count:
            fit = block // length
            blocks, rest = divmod(count - rank, fit)
            plan.append(Placement(length, rank, count - rank, fit, opened, 0))
            if blocks:
                moved.append((block - fit * length, opened, blocks))
            if rest:
                moved.append((block - rest * length, opened + blocks, 1))
            opened += blocks + bool(rest)
        for space, first, n in moved:
            if space:
                free.setdefault(space, []).append((first, n))
        for ranges in free.values():
            ranges.sort()
    return plan
