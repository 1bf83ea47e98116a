"""Golomb-Rice codes for sorted 64-bit fingerprints."""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<IBQ")


def encode(sorted_keys: np.ndarray) -> bytes:
    """Gaps between sorted keys: quotients by a power of two in unary, remainders in binary.

    The power is the one next to the mean gap, which is within a bit per key of
    the best for evenly spread keys.
    """
    keys = np.asarray(sorted_keys, np.uint64)
    if not len(keys):
        return HEADER.pack(0, 0, 0)
    gaps = np.diff(keys)
    mean = int(keys[-1] - keys[0]) // max(1, len(gaps))
    low = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    head = HEADER.pack(len(keys), low, int(keys[0]))
    first = np.packbits(unary).tobytes()
    bits = np.zeros((len(gaps), low), np.uint8)
    for i in range(low):
        bits[:, i] = (gaps >> np.uint64(i)) & np.uint64(1)
    return head + struct.pack("<I", len(first)) + first + np.packbits(bits.ravel()).tobytes()


def decode(blob: bytes) -> np.ndarray:
    """The keys that ``encode`` was given."""
    n, low, start = HEADER.unpack_from(blob)
    if n == 0:
        return np.zeros(0, np.uint64)
    at = HEADER.size
    (size,) = struct.unpack_from("<I", blob, at)
    at += 4
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, at)))[:n - 1]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(blob, np.uint8, -1, at + size))[:(n - 1) * low].reshape(n - 1, low)
    gaps = quotients.astype(np.uint64) << np.uint64(low)
    for i in range(low):
        gaps |= bits[:, i].astype(np.uint64) << np.uint64(i)
    keys = np.empty(n, np.uint64)
    keys[0] = start
    np.cumsum(gaps, out=keys[1:])
    keys[1:] += np.uint64(start)
    return keys


def bitmap(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def unbitmap(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)
