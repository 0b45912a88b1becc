"""Spelling variants: words one edit apart, found by blocked Gram matrices of their letter counts.

One inserted or deleted letter changes a word's letter counts by squared distance one, one replaced letter by two.  A
block holds the words of equal counts in six groups of letters (so of equal length); near words lie in one block or in
two whose counts differ by one letter more, one less, or one moved to another group.  A block meets its neighbours as
numpy products of count matrices; pairs at squared distance two at most go through an exact check of the edit.  Blocks
are cut into tiles of bounded size, and what visits a tile streams past it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.graph import jump
from reelsift.llm.scratch import written
from reelsift.llm.textkit import buffers, slices
from reelsift.llm.wordscan import cut, hashes

TYPO_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
TILE_WORDS = 4096
TILE_BYTES = 1 << 20
GROUPS = 6  # of letters, for the blocks
COLUMNS = 32  # of a count matrix: a-z, and six that the other letters share
CELLS = 1 << 20  # of a product held at once
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = _c >> 1 ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_i] = _c
_SHORT = 64  # bytes of words whose checksums are taken side by side


def _letters(off: np.ndarray, data: np.ndarray):
    """Runs of A-Z, a-z, U+00C0 to U+00FF (0xC3 and any byte after it) with A-Z as a-z; and the running number of 0xC3."""
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    wide = data == 0xC3
    solid = ((low >= 97) & (low <= 122)) | wide
    solid[1:] |= wide[:-1]
    return cut(off, solid, low), np.concatenate([[0], np.cumsum(wide)])


def checksums(w, prefix: np.ndarray) -> np.ndarray:
    """crc32 of each word's bytes going on from its text's ``prefix`` (a crc32)."""
    size = w.end - w.start
    state = prefix[w.owner] ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    long = int((size > _SHORT).sum())
    for i in order[:long]:
        state[i] = zlib.crc32(w.data[w.start[i] : w.end[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = order[long:]
    s, start, n = state[order], w.start[order], size[order]
    for j in range(int(n[0]) if len(n) else 0):
        m = int(np.searchsorted(-n, -j, "left"))  # words with more than j bytes come first
        s[:m] = _CRC[(s[:m] ^ w.data[start[:m] + j]) & np.uint32(255)] ^ (s[:m] >> np.uint32(8))
    state[order] = s
    return state ^ np.uint32(0xFFFFFFFF)


def _gathered(w, at: np.ndarray) -> pa.Array:
    size = w.end[at] - w.start[at]
    to = np.cumsum(size)
    data = w.data[np.arange(to[-1] if len(to) else 0) - np.repeat(to - size, size) + np.repeat(w.start[at], size)]
    off = np.concatenate([[0], to]).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes()))


def _counted(every: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w, wide = _letters(*buffers(b.column("text")))
            if not len(w.start):
                continue
            prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in b.column("doc_id").to_pylist()], np.uint32)
            h = checksums(w, prefix)
            letters = w.end - w.start - (wide[w.end] - wide[w.start])
            typo = h % np.uint32(every) == 0
            plain = np.flatnonzero(~typo & (letters >= least))
            _, first, n = np.unique(hashes(w)[plain], return_index=True, return_counts=True)
            cutback: Counter[str] = Counter()
            for i in np.flatnonzero(typo & (letters > least)):
                word = w.data[w.start[i] : w.end[i]].tobytes().decode()
                k = int(h[i]) % len(word)
                cutback[word[:k] + word[k + 1 :]] += 1
            yield pa.RecordBatch.from_arrays([_gathered(w, plain[first]), pa.array(n, pa.int64())], names=["word", "n"])
            if cutback:
                yield pa.RecordBatch.from_arrays([pa.array(list(cutback), pa.string()), pa.array(list(cutback.values()), pa.int64())], names=["word", "n"])

    return run


def word_counts(docs: DataFrame, every: int = TYPO_EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: runs of letters with A-Z as a-z, of ``least_length`` letters and ``least_count`` occurrences or more, where
    every ``every``-th run (by the crc32 of ``<doc_id>:<run>``, a null id is empty) has lost one letter."""
    found = docs.select("doc_id", "text").mapInArrow(_counted(every, least_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- blocks -----------------------------------------------------------------------------------------------------


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, longest) code points, padded with 0, and lengths of a binary column of Latin-1 words."""
    off, data = buffers(column)
    size = np.diff(off)
    out = np.zeros((len(size), int(size.max()) if len(size) else 0), np.uint8)
    owner = np.repeat(np.arange(len(size)), size)
    out[owner, np.arange(len(data)) - off[:-1][owner]] = data
    return out, size


def _column_of() -> np.ndarray:
    col = 26 + np.arange(256) % (COLUMNS - 26)
    col[97:123] = np.arange(26)
    return col


def letter_counts(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(words, COLUMNS) counts: exact in float32 for words of up to 2,000 letters, beyond in float64."""
    n, width = codes.shape
    inside = np.arange(width) < size[:, None]
    cell = (np.arange(n)[:, None] * COLUMNS + _column_of()[codes])[inside]
    return np.bincount(cell, minlength=n * COLUMNS).reshape(n, COLUMNS).astype(np.float32 if width <= 2000 else np.float64)


def block_keys(counts: np.ndarray) -> np.ndarray:
    """Counts in GROUPS groups of columns, 10 bits each (from 1,023 on all the same, which keeps neighbours adjacent)."""
    group = np.stack([counts[:, g::GROUPS].sum(1) for g in range(GROUPS)], 1)
    key = np.zeros(len(counts), np.int64)
    for g in range(GROUPS):
        key = key << 10 | np.minimum(group[:, g], 1023).astype(np.int64)
    return key


def _steps() -> list[tuple[int, int]]:
    """(added, taken) of the adjacent blocks of larger key; taken 0: one letter more."""
    one = [1 << 10 * g for g in range(GROUPS)]
    return [(a, 0) for a in one] + [(a, b) for a in one for b in one if a > b]


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word at its own block (role 0), and as a visitor (role 1) at the adjacent blocks of larger key."""
    steps = _steps()
    for b in slices(batches, "word", 64 << 10):
        key = block_keys(letter_counts(*_rows(b.column("word"))))
        at, keys, role = [np.arange(len(key))], [key], [np.zeros(len(key), np.int32)]
        for more, less in steps:
            count = lambda unit: key // unit & 1023
            ok = (count(more) < 1023) & ((count(less) > 0) if less else True)
            i = np.flatnonzero(ok)
            at.append(i), keys.append(key[i] + more - less), role.append(np.ones(len(i), np.int32))
        take = pa.array(np.concatenate(at))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(role)), b.column("word").take(take), b.column("n").take(take)], names=["key", "role", "word", "n"])


def one_edit(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Row by row: do the padded words differ by exactly one inserted, deleted or replaced code point?"""
    out = np.zeros(len(a), bool)
    if not len(a):
        return out
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    same = la == lb
    out[same] = (a[same] != b[same]).sum(1) == 1
    for short, long, rows in ((a, b, lb - la == 1), (b, a, la - lb == 1)):
        s, g = short[rows], long[rows]
        if len(s):
            first = np.argmax(s != g, axis=1)  # they differ at the shorter one's end at the latest
            late = s[:, :-1] != g[:, 1:]
            out[rows] = ~(late & (np.arange(width - 1) >= first[:, None])).any(1)
    return out


class _Side:
    """Words of a tile or of its visitors, ready for products."""

    def __init__(self, word: pa.Array, n: np.ndarray):
        self.word, self.n = word, n
        self.codes, self.size = _rows(word)
        self.counts = letter_counts(self.codes, self.size)
        self.norm = (self.counts * self.counts).sum(1)
        # an edit leaves the first half or the rest of the shorter word as it is
        halves = [(self.size // 2, self.size - self.size // 2), ((self.size - 1) // 2, self.size - 1 - (self.size - 1) // 2)]
        self.half = [[self._part(0, h), self._part(self.size - r, self.size)] for h, r in halves]

    def _part(self, start, end) -> np.ndarray:
        place = np.arange(self.codes.shape[1])
        inside = (place >= np.reshape(start, (-1, 1))) & (place < np.reshape(end, (-1, 1)))
        acc = np.zeros(len(self.size), np.uint64)
        for j in range(self.codes.shape[1]):
            acc = np.where(inside[:, j], (acc + self.codes[:, j]) * np.uint64(0x9E3779B97F4A7C15) ^ (acc >> np.uint64(29)), acc)
        return acc


def near_pairs(home: _Side, other: _Side, self_join: bool) -> tuple[np.ndarray, np.ndarray]:
    """(home, other) places of words one edit apart."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, CELLS // max(1, len(other.n)))
    for at in range(0, len(home.n), step):
        part = slice(at, at + step)
        distance = home.norm[part, None] + other.norm[None, :] - 2 * (home.counts[part] @ other.counts.T)
        i, j = np.nonzero(distance <= 2)
        i += at
        if self_join:
            i, j = i[i < j], j[i < j]
        d = home.size[i] - other.size[j]
        maybe = np.zeros(len(i), bool)
        for gap, mine, its in ((0, 0, 0), (1, 1, 0), (-1, 0, 1)):
            rows = np.flatnonzero(d == gap)
            (p, q), (r, s) = home.half[mine], other.half[its]
            maybe[rows] = (p[i[rows]] == r[j[rows]]) | (q[i[rows]] == s[j[rows]])
        i, j = i[maybe], j[maybe]
        for k in range(0, len(i), 1 << 15):
            x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
            ok = one_edit(home.codes[x], home.size[x], other.codes[y], other.size[y])
            found.append((x[ok], y[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _best(mine: _Side, i: np.ndarray, other: _Side, j: np.ndarray, order: np.ndarray) -> pa.RecordBatch | None:
    """For each word of ``mine`` in the pairs: how many, and the one of largest n, then smallest word."""
    if not len(i):
        return None
    by = np.lexsort((order[j], -other.n[j], i))
    i, j = i[by], j[by]
    head = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
    near = np.diff(np.append(head, len(i)))
    return pa.RecordBatch.from_arrays(
        [mine.word.take(pa.array(i[head])), pa.array(near, pa.int64()), pa.array(other.n[j[head]], pa.int64()), other.word.take(pa.array(j[head]))], names=["word", "n_near", "best_n", "best"]
    )


def _rank(words: pa.Array) -> np.ndarray:
    order = np.argsort(np.array([w.as_py() for w in words], object), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile, then role: the tile's own words are held, visitors stream past them."""
    here, home, held, home_rank = None, None, [], None
    for b in batches:
        for s in slices([b], "word", 64 << 10):
            key, tile, role = (s.column(c).to_numpy() for c in ("key", "tile", "role"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]) | (role[1:] != role[:-1])) + 1
            for a, z in zip([0, *cuts], [*cuts, len(key)], strict=True):
                at, part = (int(key[a]), int(tile[a])), s.slice(a, z - a)
                if at != here:
                    if held:
                        yield from _inside(_side(held))
                    here, home, held, home_rank = at, None, [], None
                if role[a] == 0:
                    held.append(part)
                elif held or home is not None:
                    if home is None:
                        home = _side(held)
                        yield from _inside(home)
                        held, home_rank = [], _rank(home.word)
                    other = _side([part])
                    i, j = near_pairs(home, other, False)
                    yield from (x for x in (_best(home, i, other, j, _rank(other.word)), _best(other, j, home, i, home_rank)) if x is not None)
    if held:
        yield from _inside(_side(held))


def _side(held: list[pa.RecordBatch]) -> _Side:
    t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return _Side(t.column("word"), t.column("n").to_numpy())


def _inside(home: _Side) -> Iterator[pa.RecordBatch]:
    """Pairs within a tile."""
    i, j = near_pairs(home, home, True)
    out = _best(home, np.concatenate([i, j]), home, np.concatenate([j, i]), _rank(home.word))
    if out is not None:
        yield out


def near_words(words: DataFrame, tile_words: int = TILE_WORDS, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """word, n_near, best, best_n of every word (distinct Latin-1 words with counts n) that has a near one: how many words
    lie one edit away, and the one of largest n (ties: smallest)."""
    words = words.select(F.encode("word", "ISO-8859-1").alias("word"), "n")
    visits = words.mapInArrow(_visits, "key long, role int, word binary, n long")
    sizes = visits.where("role = 0").groupBy("key").agg(F.count("*").alias("c"), F.sum(F.length("word")).alias("w"))
    tiles = F.ceil(F.greatest(F.col("c") / tile_words, F.col("w") / tile_bytes)).cast("int")
    large = written(sizes.select(F.col("key").alias("k"), tiles.alias("tiles")).where("tiles > 1"))
    # at most one row a tile's worth of words
    large = F.broadcast(large) if large.count() <= 100_000 else large
    placed = visits.join(large, F.col("key") == F.col("k"), "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).drop("k")
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    alone = placed.where("role = 0 or tiles = 1").withColumn("tile", own)
    # visitors of a block in tiles pass every tile; so do its own words, past the tiles before theirs
    passing = placed.where("tiles > 1").withColumn("own", own).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    passing = passing.where("role = 1 or tile < own").withColumn("role", F.lit(1)).drop("own")
    rows = alone.select("key", "tile", "role", "word", "n").unionByName(passing.select("key", "tile", "role", "word", "n"))
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "role")
    found = sorted_rows.mapInArrow(_products, "word binary, n_near long, best_n long, best binary")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    text = lambda c: F.decode(c, "ISO-8859-1")
    return out.select(text("word").alias("word"), "n_near", text("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words with counts.

    A word's form is its near word of largest n, if that is ``ratio`` times its own or more; root is the end of the chain
    of forms.  An empty table gives no rows.
    """
    words = written(words.select("word", "n"))
    near = near_words(words)
    judged = words.join(near, "word", "left").withColumn("ok", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
    judged = written(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("ok"), F.col("best")).alias("form"), F.when(F.col("ok"), F.col("best_n")).alias("form_n")))
    roots = jump(written(judged.where("form is not null").select(F.col("word").alias("id"), F.col("form").alias("comp"))))
    out = judged.join(roots.select(F.col("id").alias("word"), F.col("comp").alias("root")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, every: int = TYPO_EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n over all texts of ``docs`` (doc_id, text); see ``word_counts`` and ``variants``.

    Null and empty texts have no words; repeated rows count again; words of any length take part; an empty table, or one
    without frequent words, gives no rows.
    """
    return variants(word_counts(docs, every, least_length, least_count), ratio)
