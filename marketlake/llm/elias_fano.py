"""Elias-Fano coding of monotone sequences, on arrays that may be memory-mapped.

A value's low bits are packed; of its high bits only the steps from value to value are kept, in unary.
A directory of counts for every 64-bit word of the unary part serves random access.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np

_ONE = np.uint64(1)


class EliasFano:
    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray) -> None:
        self.size, self.low_bits = size, low_bits
        self.low, self.high, self.directory = low, high, directory

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """Of ascending values; equal neighbours are allowed."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shift = np.uint64(low_bits)
        ones = (values >> shift).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, dtype=np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bincount(ones >> 6, minlength=len(high)) if n else np.zeros(len(high), dtype=np.int64)
        directory = np.concatenate(([0], np.cumsum(counts))).astype(np.uint32)
        low = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        if low_bits:
            parts = values & ((_ONE << shift) - _ONE)
            at = np.arange(n, dtype=np.int64) * low_bits
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            _or_into(low, word, parts << bit)
            over = np.flatnonzero((at & 63) + low_bits > 64)
            _or_into(low, word[over] + 1, parts[over] >> (np.uint64(64) - bit[over]))
        return cls(n, low_bits, low, high, directory)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.uint64)
        at = index * self.low_bits
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        parts = self.low[word] >> bit
        over = np.flatnonzero((at & 63) + self.low_bits > 64)
        parts[over] |= self.low[word[over] + 1] << (np.uint64(64) - bit[over])
        return parts & ((_ONE << np.uint64(self.low_bits)) - _ONE)

    def values(self) -> np.ndarray:
        """All values, decoded in one pass."""
        ones = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little"))[: self.size]
        index = np.arange(self.size, dtype=np.int64)
        return ((ones - index).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(index)

    def access(self, index: int) -> int:
        """The value at one place, by the directory."""
        word = bisect_right(self.directory, index) - 1
        left, bits = index - int(self.directory[word]), int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = word * 64 + (bits & -bits).bit_length() - 1
        return ((one - index) << self.low_bits) | int(self._low(np.array([index]))[0])

    def successor(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """The first place in a range whose value is at least `value`; `stop` if there is none."""
        stop = self.size if stop is None else stop
        while start < stop:
            middle = (start + stop) // 2
            if self.access(middle) < value:
                start = middle + 1
            else:
                stop = middle
        return start


def _or_into(words: np.ndarray, at: np.ndarray, parts: np.ndarray) -> None:
    """OR parts into words; `at` ascends."""
    if len(at):
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        words[at[first]] |= np.bitwise_or.reduceat(parts, first)
