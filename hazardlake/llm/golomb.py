"""Golomb coding of sorted hashes with a power-of-two divisor, vectorised in both directions."""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<IBI")


def encode(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct integers below ``span``: unary quotients and fixed-width remainders of the gaps."""
    n = len(values)
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    width = max(0, int(span // max(n, 1)).bit_length() - 1)
    ends = np.cumsum((gaps >> width) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 1
    low = ((gaps[:, None] >> np.arange(width)) & 1).astype(np.uint8)
    return HEADER.pack(n, width, len(unary)) + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def decode(blob: bytes) -> np.ndarray:
    n, width, length = HEADER.unpack_from(blob)
    body = np.frombuffer(blob, np.uint8, offset=HEADER.size)
    split = (length + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:split], count=length))
    quotients = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(body[split:], count=n * width).reshape(n, width).astype(np.int64)
    return np.cumsum((quotients << width) + (low << np.arange(width)).sum(axis=1))
