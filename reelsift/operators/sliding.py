"""User features over the rows before each row, sliding: one row enters the frame, one leaves.

Rows come sorted by user and time, a user's rows one after the other.  Every statistic is a running total from which the
total ``history`` rows earlier is taken away: counts, sums and squares of ratings and years, and one count a genre.  So
a row costs the same however long the history is, and no list of a frame's rows is ever built.  Sums start anew with
each chunk of rows, around the chunk's own middle, so their rounding doesn't grow with a user's history.

Chunks are worked through in numpy across users (no loop over users or rows); the last ``history`` rows of a chunk stay
as the next one's context.  Memory is one Arrow batch and one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_ROWS = 2048
CELLS = 1 << 21  # genre counts held at once


@dataclass
class _Rows:
    """The columns that frames are made of; ``first``: row at which the row's user begins (or began, in the context)."""

    first: np.ndarray
    item: np.ndarray
    liked: np.ndarray
    rating: np.ndarray
    year: np.ndarray
    genre_off: np.ndarray
    genre: np.ndarray  # codes in ``names``
    names: np.ndarray  # genre names, in name order

    def part(self, a: int, z: int) -> _Rows:
        lo, hi = self.genre_off[a], self.genre_off[z]
        return _Rows(np.maximum(self.first[a:z] - a, 0), self.item[a:z], self.liked[a:z], self.rating[a:z], self.year[a:z], self.genre_off[a : z + 1] - lo, self.genre[lo:hi], self.names)


def _floats(column: pa.Array) -> np.ndarray:
    """Values as doubles; a null is NaN, and a NaN counts as missing too."""
    return pc.fill_null(pc.cast(column, pa.float64(), safe=False), float("nan")).to_numpy(zero_copy_only=False)


def _genres(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = pc.split_pattern(pc.cast(pc.fill_null(column, ""), pa.string()), "|")
    sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    keep = np.repeat(sizes > 0, pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    flat = pc.dictionary_encode(parts.flatten().filter(pa.array(keep)))
    names = np.array([x.encode() for x in flat.dictionary.to_pylist()], object)
    order = np.argsort(names, kind="stable") if len(names) else np.zeros(0, np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return np.concatenate([[0], np.cumsum(sizes)]), rank[flat.indices.to_numpy(zero_copy_only=False)] if len(rank) else np.zeros(0, np.int64), names[order]


def _merge(a: _Rows, b: _Rows) -> _Rows:
    """Context ``a`` before ``b``, whose ``first`` counts from the beginning of both."""
    names = np.array(sorted({*a.names.tolist(), *b.names.tolist()}), object)
    place = {x: i for i, x in enumerate(names)}
    code = lambda r: np.array([place[x] for x in r.names.tolist()], np.int64)[r.genre] if len(r.names) else r.genre
    both = lambda c: np.concatenate([getattr(a, c), getattr(b, c)])
    return _Rows(both("first"), both("item"), both("liked"), both("rating"), both("year"), np.append(a.genre_off, a.genre_off[-1] + b.genre_off[1:]), np.append(code(a), code(b)), names)


def moments(x: np.ndarray, start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, average and sample deviation of the numbers of x[start:at] (NaN is none), for every pair; the average of
    no number and the deviation of fewer than two are NaN."""
    known = ~np.isnan(x)
    middle = float(np.median(x[known & np.isfinite(x)])) if (known & np.isfinite(x)).any() else 0.0
    odd = np.isinf(x)
    d = np.where(known & ~odd, x - middle, 0.0)
    total = lambda v: (c := np.concatenate([[0], np.cumsum(v)]))[at] - c[start]
    n = total(known)
    with np.errstate(invalid="ignore", divide="ignore"):
        s1, s2 = total(d), total(d * d)
        mean = np.where(n > 0, middle + s1 / n, np.nan)
        spread = np.maximum(s2 - s1 * s1 / n, 0.0)
        sd = np.where(n > 1, np.sqrt(spread / (n - 1)), np.nan)
    # frames of one value are told by its changes, not by a difference of sums
    place = np.flatnonzero(known)
    change = np.zeros(len(x) + 1, bool)
    change[place[1:]] = x[place[1:]] != x[place[:-1]]
    follow = np.append(place, len(x))[np.searchsorted(place, start)]  # the frame's first number
    same = (n > 0) & (total(change[:-1]) - change[follow] == 0)
    mean[same], sd[same & (n > 1)] = x[follow[same]], 0.0
    # infinite numbers, and frames much narrower than their distance from the middle: each by itself
    for i in np.flatnonzero((total(odd) > 0) | (~same & (spread < 1e-8 * s2))):
        part = x[start[i] : at[i]]
        part = part[~np.isnan(part)]
        with np.errstate(invalid="ignore"):
            mean[i], sd[i] = part.mean(), (part.std(ddof=1) if len(part) > 1 else np.nan)
    return n, mean, sd


def _top_genres(r: _Rows, begin: int, start: np.ndarray, slots: int | None) -> pa.Array:
    """The most frequent genres of liked rows in each frame, by count then name; all of them for ``slots`` None."""
    n, out_off, out = len(start), [0], []
    owner = np.repeat(np.arange(len(r.liked)), np.diff(r.genre_off))
    use = r.liked[owner]
    owner, code = owner[use], r.genre[use]
    seen, code = np.unique(code, return_inverse=True)
    g = len(seen)
    if not g:
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()))
    step = max(1, CELLS // g)
    for a in range(0, n, step):
        z = min(n, a + step)
        low, high = int(start[a]), begin + z  # frames of these rows lie in [low, high)
        here = (owner >= low) & (owner < high)
        count = np.bincount((owner[here] - low + 1) * g + code[here], minlength=(high - low + 1) * g).reshape(-1, g).astype(np.int32)
        np.cumsum(count, axis=0, out=count)
        frame = count[begin + a - low : begin + z - low] - count[start[a:z] - low]
        # larger count first, then smaller code: one number for both
        key = frame.astype(np.int64) * g + (g - 1 - np.arange(g))
        key[frame == 0] = -1
        k = g if slots is None else min(slots, g)
        if k < g:
            key = -np.partition(-key, k - 1, axis=1)[:, :k]
        key = -np.sort(-key, axis=1)
        ok = key >= 0
        out.append(seen[g - 1 - key[ok] % g])
        out_off.append(ok.sum(1))
    sizes = np.concatenate([np.atleast_1d(x) for x in out_off])
    values = pa.DictionaryArray.from_arrays(pa.array(np.concatenate(out).astype(np.int32)), pa.array([x.decode() for x in r.names], pa.string())).dictionary_decode()
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), values)


def _recent(r: _Rows, begin: int, start: np.ndarray, slots: int | None) -> pa.Array:
    """Liked items of each frame, newest first."""
    at = np.arange(begin, begin + len(start))
    places = np.flatnonzero(r.liked)
    lo, hi = np.searchsorted(places, start), np.searchsorted(places, at)
    n = hi - lo if slots is None else np.minimum(hi - lo, slots)
    off = np.concatenate([[0], np.cumsum(n)])
    back = np.arange(off[-1]) - np.repeat(off[:-1], n)
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(r.item[places[np.repeat(hi, n) - 1 - back]] if off[-1] else np.zeros(0, r.item.dtype)))


def _frames(keys: list[str], base: list[str], history: int, slots: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            code = np.zeros(b.num_rows, np.int64)
            for k in keys:
                c = pc.dictionary_encode(b.column(k), null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
                code = code * (int(c.max()) + 1) + c
            head = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            first = np.repeat(head, np.diff(np.append(head, len(code))))
            rows = _Rows(first, b.column("item_id").to_numpy(zero_copy_only=False), pc.fill_null(pc.equal(b.column("label"), 1), False).to_numpy(zero_copy_only=False), _floats(b.column("rating")), _floats(b.column("release_year")), *_genres(b.column("genres")))
            begin = 0
            if context is not None and [b.column(k)[0].as_py() for k in keys] == last:
                begin = len(context.item)
                rows.first = np.where(first == 0, 0, first + begin)
                context.first = np.zeros(begin, np.int64)
                rows = _merge(context, rows)
            last = [b.column(k)[b.num_rows - 1].as_py() for k in keys]
            for a in range(begin, len(rows.item), CHUNK_ROWS):
                z = min(len(rows.item), a + CHUNK_ROWS)
                start = np.maximum(rows.first[a:z], np.arange(a, z) - history)
                low = int(start.min())
                part, at = rows.part(low, z), np.arange(a - low, z - low)
                yield _features(b.slice(a - begin, z - a).select(base), part, a - low, start - low, at, slots)
            # what a later row of the last user can still look back on
            keep = max(int(rows.first[-1]), len(rows.item) - history)
            context = rows.part(keep, len(rows.item))

    return run


def _features(base: pa.RecordBatch, r: _Rows, begin: int, start: np.ndarray, at: np.ndarray, slots: int | None) -> pa.RecordBatch:
    _, year, year_sd = moments(r.year, start, at)
    _, rating, rating_sd = moments(r.rating, start, at)
    number = lambda x: pa.array(x, pa.float64(), mask=np.isnan(x))
    columns = [_recent(r, begin, start, slots), pa.array(at - start, pa.int64()), number(year), number(year_sd), number(rating), number(rating_sd), _top_genres(r, begin, start, slots)]
    return pa.RecordBatch.from_arrays([*base.columns, *columns], names=[*base.schema.names, *(f.name for f in fields(T.LongType()))])


def fields(item_type: T.DataType) -> list[T.StructField]:
    """Columns that ``add_frames`` adds."""
    kinds = [("_hist", T.ArrayType(item_type)), ("user_rating_count", T.LongType()), ("_avg_year", T.DoubleType()), ("_year_sd", T.DoubleType()), ("_avg_rating", T.DoubleType()), ("_rating_sd", T.DoubleType()), ("_genres", T.ArrayType(T.StringType()))]
    return [T.StructField(n, t) for n, t in kinds]


def add_frames(samples: DataFrame, keys: list[str], order: list[str], base: list[str], history: int, slots: int | None) -> DataFrame:
    """``base`` columns of ``samples`` and, over the ``history`` rows of the same ``keys`` before each row in ``order``:
    ``_hist`` (liked items, newest first), ``user_rating_count``, the averages and sample deviations of release_year and
    rating (nulls left out), and ``_genres`` (of liked rows, by frequency then name).  ``slots``: only so many of each
    list.  A genre string splits at ``|``; a null one has no genres."""
    rows = samples.repartition(*keys).sortWithinPartitions(*keys, *order)
    item = samples.schema["item_id"].dataType
    schema = T.StructType([*(samples.schema[c] for c in base), *fields(item)])
    return rows.mapInArrow(_frames(keys, base, history, slots), schema)
