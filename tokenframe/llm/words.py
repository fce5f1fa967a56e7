"""Words of many texts at once, as arrays: numpy over the bytes of an Arrow column.

A word is a maximal run of bytes outside a set of breaks. It is told apart by a 64-bit hash
of its bytes, the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of about this many bytes are worked on together; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NOT_BLANK = np.array([b not in BLANKS for b in range(256)])
#: ASCII letters and digits, and every byte of a character beyond ASCII.
ALPHANUMERIC = np.array([b > 0x7F or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class _Powers:
    """Powers of the base modulo 2**64, and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grown = max(n, SLICE_BYTES)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(grown, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of a run of texts: hashes, byte places, and the first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words, and where such runs begin, within one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        whole = chained([self.hashes[k : k + n] for k in range(size)])
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        at = np.flatnonzero(np.arange(n) + size <= last)
        return whole[at], at


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes, its length included."""
    total = np.full(parts[0].shape, len(parts), np.uint64)
    for part in parts:
        total = total * _STEP + part
    return mixed(total)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column with 64-bit offsets and no NULLs, which become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``limit`` bytes."""
    lo, n = 0, len(texts)
    ends = _offsets(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]


def words_in(
    texts: pa.Array, lo: int, hi: int, lower: bool = False, inside: np.ndarray = NOT_BLANK
) -> Words:
    offsets = _offsets(texts)[lo : hi + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    if lower:
        data = LOWER[data]
    held = inside[data]
    borders = offsets[:-1][offsets[:-1] < n]
    begins, stops = held.copy(), held.copy()
    if n:
        begins[1:] &= ~held[:-1]
        begins[borders] = held[borders]
        stops[:-1] &= ~held[1:]
        last = borders[borders > 0] - 1
        stops[last] = held[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data, offsets)
