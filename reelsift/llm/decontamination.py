"""Benchmark decontamination with suffix arrays of the training text.

A shard is a slice of the documents.  Its suffix array holds the places of its words sorted by the words that follow,
as deep as a window; places that begin no test window's first two words are left out, as no test suffix can meet them.
Every test suffix is found in every shard's array by binary search: the range of equal suffixes is all places where its
window occurs.  Windows that follow each other on one diagonal are one longest verbatim match.

The benchmark goes to the tasks in blocks of bounded size, the documents are read once a block and never shuffled for
one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.scratch import written
from reelsift.llm.textkit import slices
from reelsift.llm.wordscan import hashes, words_of

WINDOW = 10
BLOCK_BYTES = 8 << 20  # benchmark text searched at once
SHARD_BYTES = 4 << 20  # document text read at once
SHARD_PLACES = 1 << 18  # places under one suffix array
_FILTER_BITS = 22

SOLID = np.ones(256, bool)  # words are digits, letters and all beyond ASCII
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    SOLID[_a : _b + 1] = False


@dataclass
class TestBlock:
    """Distinct windows of some test items and where they occur in them."""

    vocab: np.ndarray  # sorted word hashes; code = place + 1
    bits: int  # of a code
    size: np.ndarray  # words of each distinct window
    low: np.ndarray  # (windows, keys): packed codes, then zeros
    high: np.ndarray  # the same, then ones
    begins: np.ndarray  # bit filter of (first code, second code) of windows
    off: np.ndarray  # occurrences of window i in the items: off[i] .. off[i + 1]
    item: np.ndarray  # index into ``names``, ascending within a window
    at: np.ndarray  # first word in the item
    names: list[str]  # item ids in string order
    window: int


def _packed(codes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, depth) codes as rows of 63-bit keys that sort alike."""
    per = 63 // bits
    keys = []
    for c in range(0, codes.shape[1], per):
        acc = np.zeros(len(codes), np.int64)
        for j in range(c, min(c + per, codes.shape[1])):
            acc = acc << bits | codes[:, j]
        keys.append(acc)
    return np.stack(keys, 1) if keys else np.zeros((len(codes), 0), np.int64)


def _pair_bit(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def test_block(ids: list, texts: pa.Array, window: int) -> TestBlock:
    """The block of items; a null id is named '', items of one id are one item."""
    w = words_of(texts, SOLID)
    vocab, code = np.unique(hashes(w, True), return_inverse=True)
    code = code.astype(np.int64) + 1
    bits = max(1, int(len(vocab) + 1).bit_length())
    name = ["" if i is None else str(i) for i in ids]
    names = sorted(set(name))
    rank = {x: i for i, x in enumerate(names)}
    owner, count = w.owner, w.count
    place = np.arange(len(code)) - w.off[:-1][owner]
    size = np.minimum(count, window)[owner]
    starts = np.flatnonzero(place + size <= count[owner])  # the suffixes that hold a whole window
    reach = np.arange(window)
    inside = reach < size[starts][:, None]
    grams = np.where(inside, code[np.minimum(starts[:, None] + reach, max(len(code) - 1, 0))] if len(code) else 0, 0)
    low = _packed(grams, bits)
    key, back = np.unique(low, axis=0, return_inverse=True) if len(low) else (low, np.zeros(0, np.int64))
    back = back.reshape(-1)
    item = np.array([rank[name[i]] for i in owner[starts]], np.int64)
    order = np.lexsort((place[starts], item, back))
    off = np.searchsorted(back[order], np.arange(len(key) + 1))
    one = order[off[:-1]] if len(key) else np.zeros(0, np.int64)  # a suffix of each distinct window
    high = _packed(np.where(inside[one], grams[one], (1 << bits) - 1), bits)
    begins = np.zeros(1 << _FILTER_BITS, bool)
    two = size[starts][one] > 1
    if window > 1:
        begins[_pair_bit(grams[one][two, 0], grams[one][two, 1])] = True
    return TestBlock(vocab, bits, size[starts][one], key, high, begins, off, item[order], place[starts][order], names, window)


def _before(keys: list[np.ndarray], query: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of every query row at once: how many sorted rows are smaller (or, right, not larger)."""
    lo, hi = np.zeros(len(query), np.int64), np.full(len(query), len(keys[0]), np.int64)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for k, column in enumerate(keys):
            value, q = column[mid], query[open_, k]
            less |= same & (value < q)
            same &= value == q
        up = less | (same if right else False)
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]


def search(block: TestBlock, w, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, window) of every occurrence of a test window in the texts of ``w`` (word hashes ``h``)."""
    none = np.zeros(0, np.int64)
    if not len(h) or not len(block.size):
        return none, none
    near = np.searchsorted(block.vocab, h)
    near[near == len(block.vocab)] = 0
    code = np.where(block.vocab[near] == h, near + 1, 0)
    owner = w.owner
    # texts lie one beside the other with a 0 between: no suffix reads on into the next text
    lane = np.zeros(len(h) + len(w.off) + block.window, np.int64)
    lane[np.arange(len(h)) + owner] = code
    if (block.size == 1).any():
        place = np.flatnonzero(lane)
    else:
        place = np.flatnonzero(lane[:-1] * lane[1:])
        place = place[block.begins[_pair_bit(lane[place], lane[place + 1])]]
    if not len(place):
        return none, none
    slot = np.cumsum(lane > 0) - 1  # of known words: back from the lane to the word's number
    known = np.flatnonzero(code)
    at, window = [], []
    for i in range(0, len(place), SHARD_PLACES):
        hits, n = _shard(block, lane, place[i : i + SHARD_PLACES])
        at.append(known[slot[hits]])
        window.append(np.repeat(np.arange(len(n)), n))
    return np.concatenate(at), np.concatenate(window)


def _shard(block: TestBlock, lane: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all test windows, window by window, and each window's count, from the suffix array of ``place``."""
    follow = np.empty((len(place), block.window), np.int64)
    alive = np.ones(len(place), bool)
    for j in range(block.window):
        follow[:, j] = lane[place + j] * alive
        alive &= follow[:, j] > 0
    suffix = _packed(follow, block.bits)
    order = np.lexsort(suffix.T[::-1])
    keys = [suffix[order, k] for k in range(suffix.shape[1])]
    lo, hi = _before(keys, block.low, False), _before(keys, block.high, True)
    n = hi - lo
    return place[order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]], n


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted intervals [first, last) merged where they touch."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return first[at], reach[np.append(at[1:] - 1, len(first) - 1)]


HITS = "row long, doc_id long, n_words long, first array<long>, last array<long>, items array<string>"


def _hits(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = block.value
        for b in slices(batches, "text", SHARD_BYTES):
            w = words_of(b.column("text"), SOLID)
            at, window = search(test, w, hashes(w, True))
            order = np.argsort(at, kind="stable")
            at, window = at[order], window[order]
            edge = np.searchsorted(at, w.off)
            first, last, items = [], [], []
            for i in range(b.num_rows):
                a, z = edge[i], edge[i + 1]
                if a == z:
                    first.append([]), last.append([]), items.append([])
                    continue
                lo, hi = _runs(at[a:z] - w.off[i], at[a:z] - w.off[i] + test.size[window[a:z]])
                first.append(lo), last.append(hi)
                met = np.unique(window[a:z])
                who = np.unique(np.concatenate([test.item[test.off[x] : test.off[x + 1]] for x in met]))
                items.append([test.names[x] for x in who])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(w.count, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(last, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=["row", "doc_id", "n_words", "first", "last", "items"],
            )

    return run


MATCHES = "row long, doc_id long, item_id string, doc_word long, item_word long, n_words long"


def _chains(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = block.value
        for b in slices(batches, "text", SHARD_BYTES):
            w = words_of(b.column("text"), SOLID)
            at, window = search(test, w, hashes(w, True))
            n = np.diff(test.off)[window]
            each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(test.off[window], n)
            at, size, item, start = np.repeat(at, n), np.repeat(test.size[window], n), test.item[each], test.at[each]
            text = np.searchsorted(w.off, at, "right") - 1
            at = at - w.off[text]
            order = np.lexsort((at, at - start, item, text))
            text, item, at, start, size = text[order], item[order], at[order], start[order], size[order]
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | ((at - start)[1:] != (at - start)[:-1]) | (at[1:] > at[:-1] + 1)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(at)) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("row").take(pa.array(text[head])), b.column("doc_id").take(pa.array(text[head])), pa.array([test.names[x] for x in item[head]], pa.string()),
                    pa.array(at[head]), pa.array(start[head]), pa.array(at[tail] + size[tail] - at[head]),
                ],
                names=["row", "doc_id", "item_id", "doc_word", "item_word", "n_words"],
            )

    return run


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator:
    """The benchmark as broadcast blocks of about ``block_bytes`` of text, one at a time on the driver."""
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    items = (written(items) if blocks > 1 else items).withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)))
    for i in range(blocks):
        part = items.where(F.col("block") == i).select("item_id", "text").toArrow()
        text = part["text"].combine_chunks()
        block = test_block(part["item_id"].to_pylist(), text, window)
        yield benchmark.sparkSession.sparkContext.broadcast(block)


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, body: Callable, schema: str) -> list[DataFrame]:
    return [docs.mapInArrow(body(block), schema) for block in _blocks(benchmark, window, block_bytes)]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hit, count, sha = [], [], []
        for first, last, items in zip(b.column("first"), b.column("last"), b.column("items"), strict=True):
            n = 0
            if len(first):
                lo, hi = _runs(first.values.to_numpy(), last.values.to_numpy())
                n = int((hi - lo).sum())
            names = sorted(set(items.as_py()))
            hit.append(n), count.append(len(names)), sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("doc_id"), b.column("n_words"), pa.array(hit, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in hit], pa.bool_())],
            names=["row", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _judged(rows: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """``rows`` has a row number that is the same whenever it is read, if the benchmark has several blocks."""
    found = _passes(rows, benchmark, window, block_bytes, _hits, HITS)
    hits = reduce(DataFrame.unionByName, found)
    if len(found) > 1:
        both = lambda c: F.flatten(F.collect_list(c)).alias(c)
        hits = hits.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), both("first"), both("last"), both("items"))
    return hits.mapInArrow(_digests, "row long, doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _free(df: DataFrame, name: str) -> str:
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written with a number a row: the same whenever it is read."""
    return written(docs.withColumn(name, F.monotonically_increasing_id()))



def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for every row of ``docs``.

    A word is hit when it lies in an occurrence of ``window`` consecutive words of an item (of the whole item, if it is
    shorter); A-Z count as a-z.  Null and empty texts, and texts without words, have no words and are clean; equal rows
    give equal rows; a null item id is the item ''; an empty benchmark leaves all clean; an empty table has no rows.
    Texts of any length are searched whole; a long one lies under several suffix arrays.
    """
    rows = docs.select("doc_id", "text")
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total > block_bytes:
        rows = _numbered(rows, "row")
    else:
        rows = rows.withColumn("row", F.lit(0).cast("long"))
    return _judged(rows, benchmark, window, block_bytes).drop("row")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id (as text), doc_word, item_word, n_words: every longest run of words that a document and an item
    share verbatim, of ``window`` words or more (or a whole shorter item), with its first word in both (from 0).
    Nulls, empty and repeated rows as in ``contamination``."""
    rows = docs.select("doc_id", "text", F.lit(0).cast("long").alias("row"))
    return reduce(DataFrame.unionByName, _passes(rows, benchmark, window, block_bytes, _chains, MATCHES)).drop("row")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that no window of the benchmark occurs in, with all their columns.  Rows are told apart by
    their place in the table, so null and repeated ids are judged each by its own text."""
    row = _free(docs, "row")
    kept = _numbered(docs, row)
    rows = kept.select("doc_id", "text", F.col(row).alias("row"))
    bad = _judged(rows, benchmark, window, block_bytes).where("contaminated").select(F.col("row").alias(row))
    return kept.join(bad, row, "left_anti").select(*docs.columns)
