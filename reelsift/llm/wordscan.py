"""Words of any byte class and their 64-bit hashes, from one running sum over the bytes of a slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from reelsift.llm.textkit import Words, buffers, mix

RUN_BYTES = 1 << 18  # bytes under one running sum: bounds the temporaries

_rng = np.random.default_rng(97_003)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]  # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]), dtype=np.uint64)


def cut(off: np.ndarray, solid: np.ndarray, data: np.ndarray) -> Words:
    """Maximal runs of ``solid`` bytes inside each text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(off), np.int64), data, off)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, np.searchsorted(start, off), data, off)


def words_of(texts: pa.Array, solid: np.ndarray) -> Words:
    """Words of a string column as runs of the bytes that ``solid`` (256 flags) names."""
    off, data = buffers(texts)
    return cut(off, solid[data], data)


def hashes(w: Words, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word: differences of a running polynomial sum, shifted back to the word's start."""
    table = BYTE_LOWER if lower else BYTE
    out = np.empty(len(w.start), np.uint64)
    size = min(RUN_BYTES, len(w.data))
    power, back = _powers(_BASE, size), _powers(_BACK, size)
    at = 0
    while at < len(out):
        low = int(w.start[at])
        to = max(at + 1, int(np.searchsorted(w.end, low + RUN_BYTES, "right")))
        n = int(w.end[to - 1]) - low
        if n >= len(power):  # one word longer than a run
            power, back = _powers(_BASE, n), _powers(_BACK, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[w.data[low : low + n]] * power[:n], out=total[1:])
        a, b = w.start[at:to] - low, w.end[at:to] - low
        out[at:to] = mix((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64))
        at = to
    return out
