"""Vectorised word and shingle hashing over Arrow string columns (numpy, no per-word Python).

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; word hashes are position independent 64-bit values, so equal
words hash equally in every batch, task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # text bytes handled at once: bounds the temporaries of every operator
HASH_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(4095, _BASE)]), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
    return _POWERS


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return off - off[0], data[off[0] : off[-1]]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch cut into runs of rows with about ``size`` bytes of text (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        off, _ = buffers(b.column(column))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


@dataclass
class Words:
    start: np.ndarray  # byte offsets in ``data``
    end: np.ndarray
    off: np.ndarray  # word offsets per text, one more than texts
    data: np.ndarray
    text_off: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.off)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.count)


def words(texts: pa.Array) -> Words:
    off, data = buffers(texts)
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(off), np.int64), data, off)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, np.searchsorted(start, off), data, off)


def hash_spans(w: Words, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``lower`` maps A-Z to a-z first."""
    table = _BYTE_LOWER if lower else _BYTE
    lens = w.end - w.start
    out = np.empty(len(lens), np.uint64)
    done = np.concatenate([[0], np.cumsum(lens)])
    at = 0
    while at < len(lens):
        to = max(at + 1, int(np.searchsorted(done, done[at] + HASH_BYTES, "right")) - 1)
        n = lens[at:to]
        begin = done[at:to] - done[at]
        within = np.arange(done[to] - done[at]) - np.repeat(begin, n)
        value = table[w.data[within + np.repeat(w.start[at:to], n)]]
        value *= _powers(int(n.max()))[within]
        out[at:to] = mix(np.add.reduceat(value, begin) + n.astype(np.uint64))
        at = to
    return out


def shingles(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words inside a text, with offsets per text.  A text of 1 to k-1 words gives its
    whole sequence as one shingle, a text without words none."""
    count = np.diff(off)
    acc = np.zeros(len(h), np.uint64)
    short = (count > 0) & (count < k)
    n = np.where(count >= k, count - k + 1, short.astype(np.int64))
    for j in range(k):  # one word more each time; a short text stops at its end
        here = np.arange(len(h)) + j
        inside = here < np.repeat(off[1:], count)
        here = here[inside]
        acc[inside] = mix(acc[inside] * _M2 + h[here] + np.uint64(j + 1))
    out_off = np.concatenate([[0], np.cumsum(n)])
    index = np.arange(out_off[-1]) - np.repeat(out_off[:-1], n) + np.repeat(off[:-1], n)
    return acc[index], out_off


def distinct_sets(s: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, with offsets."""
    parts, sizes = [], np.zeros(len(off), np.int64)
    for i in range(len(off) - 1):
        if off[i] == off[i + 1]:
            continue
        a = np.sort(s[off[i] : off[i + 1]])
        if len(a) > 1:
            a = a[np.concatenate([[True], a[1:] != a[:-1]])]
        parts.append(a)
        sizes[i + 1] = len(a)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def long_list(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values.view(np.int64)))
