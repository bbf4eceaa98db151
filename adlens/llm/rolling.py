"""Vectorised polynomial hashes over byte buffers (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


_KNOWN: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... (n of them, modulo 2**64); computed once per size class."""
    size = 1 << max(16, (n - 1).bit_length())
    if (base, size) not in _KNOWN:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        _KNOWN[base, size] = np.cumprod(out, dtype=np.uint64)
    return _KNOWN[base, size][:n]


def prefix_hash(buffer: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of (byte j + 1) * base**j over j < i."""
    out = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(buffer)), out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal bytes, equal hash."""
    inverse = powers(_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
