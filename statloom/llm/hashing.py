"""Vectorised hashes of byte strings, for use inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(size, v, np.uint64) for v in (_BASE, _INVERSE))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` at least; kept per worker up to the
    longest text so far, in powers of two."""
    return _powers(1 << max(16, (n - 1).bit_length()))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: ``span_hash`` of any span follows from two of its values."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``[start, stop)``; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(prefix))
    return mixed((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))
