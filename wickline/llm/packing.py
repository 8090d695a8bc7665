"""Arrays of integers as compact bytes, for shuffles that carry many of them in one row."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values, byte plane by byte plane, compressed; sort or take differences before."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit keys."""
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
