"""Arrays of whole numbers as bytes, for rows that chunks and buckets exchange."""

from __future__ import annotations

import numpy as np


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, byte by byte, so that the zeros of small ones lie together and compress."""
    wide = np.ascontiguousarray(numbers).astype(np.uint64)
    size = max(1, (int(wide.max()).bit_length() + 7) // 8) if len(wide) else 1
    return bytes([size]) + wide.view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def numbers(data: bytes) -> np.ndarray:
    size = data[0]
    found = np.frombuffer(data, np.uint8, offset=1).reshape(size, -1)
    wide = np.zeros((found.shape[1], 8), np.uint8)
    wide[:, :size] = found.T
    return wide.view(np.uint64).ravel()


def steps(ascending: np.ndarray) -> bytes:
    """Numbers in ascending order, as their differences."""
    return planes(np.diff(ascending.astype(np.uint64), prepend=np.uint64(0)))


def unstepped(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data), dtype=np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)
