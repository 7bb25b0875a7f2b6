"""Golomb coding of sorted distinct 64-bit hashes (power-of-two parameter).

A run of hashes is sent as gaps; a gap is a unary quotient and ``k`` remainder
bits. With ``k`` near log2(0.69 * mean gap) a hash costs about log2(mean gap)
+ 1.5 bits instead of 64.
"""

from __future__ import annotations

import math

import numpy as np


def parameter(span: int, n: int) -> int:
    """Remainder bits for ``n`` hashes spread over ``span`` values."""
    return max(0, min(63, int(math.log2(max(1.0, 0.69 * span / max(1, n))))))


def encode(hashes: np.ndarray, low: int, k: int) -> bytes:
    """``hashes``: strictly increasing uint64, none below ``low``."""
    n = len(hashes)
    gaps = np.diff(hashes, prepend=np.uint64(low))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 1
    bits = (gaps[:, None] >> np.arange(k, dtype=np.uint64)[None, :]) & np.uint64(1)
    return (len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes()
            + np.packbits(bits.astype(np.uint8).ravel()).tobytes())


def decode(code: bytes, n: int, low: int, k: int) -> np.ndarray:
    """The ``n`` hashes that ``encode`` packed."""
    if n == 0:
        return np.zeros(0, np.uint64)
    size = int.from_bytes(code[:8], "little")
    cut = 8 + (size + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[8:cut], np.uint8), count=size)
    gaps = (np.diff(np.flatnonzero(unary), prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(code[cut:], np.uint8), count=n * k).reshape(n, k)
        gaps += bits.astype(np.uint64) @ (np.uint64(1) << np.arange(k, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)
