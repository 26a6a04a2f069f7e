"""Vectorised scans of the texts of an Arrow batch, as UTF-8 bytes.

A batch's texts lie in one byte buffer; words and fingerprints are found for
the whole buffer at once and then told apart by text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Texts are taken together up to so many bytes, a longer text by itself.
PIECE_BYTES = 2 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close inputs get unrelated outputs."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=U64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=U64)
    return known[:n]


class RangeHash:
    """64-bit hash of any range of a sequence of codes, from prefix sums."""

    def __init__(self, codes: np.ndarray) -> None:
        self.sums = np.zeros(len(codes) + 1, dtype=U64)
        np.cumsum(codes * powers(_INVERSE, len(codes)), out=self.sums[1:])
        self.lift = powers(_BASE, len(codes) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.lift[start]
        return mixed(raw ^ (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = column.cast(pa.large_string())
    if large.null_count:
        large = large.fill_null("")
    _, offsets, data = large.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(large) + large.offset + 1)[large.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def pieces(at: np.ndarray, most: int = PIECE_BYTES) -> list[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes each, to bound a scan's memory."""
    out, first = [], 0
    while first < len(at) - 1:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(at) - 1)
        out.append((first, last))
        first = last
    return out


@dataclass
class Words:
    """Words of several texts: byte ranges, hashes and each text's word range."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    bounds: np.ndarray


def find_words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray, lower: np.ndarray) -> Words:
    """Maximal runs of bytes that ``inside`` (256 flags) marks, by text;
    ``lower`` maps bytes before they are hashed."""
    marks = np.zeros(len(raw) + 2, dtype=np.int8)
    marks[1:-1] = inside[raw]
    begins = marks[1:] & ~marks[:-1] & 1
    ends = marks[:-1] & ~marks[1:] & 1
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    both = (marks[cuts] & marks[cuts + 1]).astype(bool)
    begins[cuts[both]] = 1
    ends[cuts[both]] = 1
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    hashes = RangeHash(BYTE_CODE[lower[raw]]).of(start, end)
    return Words(start, end, hashes, np.searchsorted(start, at))


def lower_ascii() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out
