"""Words and shingles as 64-bit hashes, computed on whole Arrow string columns.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. Hashes depend on the bytes alone, so they
are the same on every executor. Columns are worked on in slices of a few megabytes, since the
arrays here are eight times as wide as the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = np.arange(1, 257, dtype=np.uint64)
_LOWER = _CODE.copy()
_LOWER[65:91] += np.uint64(32)

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES)
            for name, base in (("up", _BASE), ("down", _UNBASE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]

    @classmethod
    def trim(cls) -> None:
        """Give back what one very long text needed."""
        if len(cls.up) > 4 * SLICE_BYTES:
            cls.up, cls.down = cls.up[:SLICE_BYTES].copy(), cls.down[:SLICE_BYTES].copy()

    @classmethod
    def clear(cls) -> None:
        cls.up, cls.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def forget() -> None:
    """Give back what hashing keeps, 16 bytes for each byte of a slice; for the end of a task."""
    _Powers.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread hashes over all 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def filled(column: pa.Array) -> pa.Array:
    """The column as strings with 64-bit offsets, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row. `column` comes from `filled`."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each row's words begin (one more entry than rows)."""
    rows = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + rows + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    edges = offsets - first
    if first == last:
        return np.empty(0, dtype=np.uint64), np.zeros(rows + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last]
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    up, down = _Powers.upto(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER if lower else _CODE)[data] * up, out=sums[1:])
    hashes = mix((sums[ends + 1] - sums[starts]) * down[starts])
    _Powers.trim()
    return hashes, np.searchsorted(starts, edges, side="left").astype(np.int64)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and where each row's runs begin.

    A row of fewer words has its whole sequence as one run; a row without words has none.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate(([0], np.cumsum(runs)))
    out = np.empty(int(out_bounds[-1]), dtype=np.uint64)
    total = len(hashes) - width + 1
    if total > 0:
        rolled = hashes[:total].copy()
        for i in range(1, width):
            rolled *= _STEP
            rolled += hashes[i : i + total]
        # a run is kept if it begins early enough in its own row
        row_of = np.repeat(np.arange(len(counts)), counts)[:total]
        keep = np.arange(total) + width <= bounds[row_of + 1]
        full = np.repeat(counts >= width, runs)
        out[full] = mix(rolled[keep] + np.uint64(width))
    for n in range(1, width):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            rolled = hashes[bounds[rows]].copy()
            for i in range(1, n):
                rolled *= _STEP
                rolled += hashes[bounds[rows] + i]
            out[out_bounds[rows]] = mix(rolled + np.uint64(n))
    return out, out_bounds


def shingle_sets(column: pa.Array, width: int, lower: bool = False) -> Iterator[np.ndarray]:
    """For each row, its distinct shingle hashes in ascending order."""
    for start, stop in slices(column):
        hashes, bounds = shingle_hashes(*word_hashes(column.slice(start, stop - start), lower), width)
        for i in range(stop - start):
            yield np.unique(hashes[bounds[i] : bounds[i + 1]])
