"""Arrays of numbers that travel between groups of documents and buckets of hashes, packed in rows.

A group deals its hashes to buckets, a bucket sees the hashes of all groups and answers each group. One row
holds what a group sends to a bucket, so millions of hashes make few rows.
"""

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def pack_rising(values: np.ndarray) -> bytes:
    """Sorted numbers as their differences, which pack better."""
    return pack(np.diff(values.astype("<u8"), prepend=np.uint64(0)))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 … base ** (count - 1), modulo 2 ** 64."""
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base ** i, beginning with 0; modulo 2 ** 64."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def deal(buckets: np.ndarray) -> list[tuple[int, slice]]:
    """Runs of equal numbers in a sorted array."""
    if not len(buckets):
        return []
    edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
    return [(int(buckets[a]), slice(a, b)) for a, b in zip(edges, edges[1:])]
