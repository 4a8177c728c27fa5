"""Integer arrays as bytes, place by place: the first bytes of all values, then the second."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, in as many bytes as the largest needs; that width comes first."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    whole[:, :width] = planes.T
    return whole.view("<u8").reshape(-1).astype(np.uint64)


def pack_sorted(values: np.ndarray, drop: int = 0) -> bytes:
    """Ascending integers without their lowest `drop` bits, as steps."""
    return pack(np.diff(values >> np.uint64(drop), prepend=np.uint64(0)))


def unpack_sorted(raw: bytes, drop: int = 0) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64) << np.uint64(drop)
