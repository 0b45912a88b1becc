"""MinHash fingerprints of word shingles, and near-duplicate groups by their bands.

A fingerprint holds, for each of 128 universal hash permutations, 16 bits of the smallest hash over a text's five-word
shingles; the share of equal places estimates the Jaccard likeness.  ``near_duplicates`` joins bands of the whole
32-bit minima in Spark and confirms links on full shingle sets.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.linking import full_sets, link_groups, sketch_batch
from reelsift.llm.scratch import written
from reelsift.llm.textkit import hash_spans, mix, shingles, slices, words

PERMS = 128
SHINGLE = 5
SEED = 5
PART_ROWS = 2048
MOST_PARTS = 10_000
_LOW = -(1 << 63)


def permutations(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def minima(values: np.ndarray, off: np.ndarray, perms: int = PERMS) -> tuple[np.ndarray, np.ndarray]:
    """Indices of texts with shingles, and their (texts, perms) smallest permuted 32-bit hashes."""
    full = np.flatnonzero(np.diff(off))
    x, (a, b) = (values >> np.uint64(32)).astype(np.uint32), permutations(perms)
    out = np.empty((perms, len(full)), np.uint32)
    starts = off[:-1][full]
    v = np.empty_like(x)
    for p in range(perms if len(full) else 0):
        np.multiply(x, a[p], out=v)
        np.add(v, b[p], out=v)
        out[p] = np.minimum.reduceat(v, starts)
    return full, out.T


def fingerprint(texts: pa.Array, k: int = SHINGLE, perms: int = PERMS) -> np.ndarray:
    """(texts, perms) of 16 bits; a text without words has all places 0 and is known by ``has_words``."""
    w = words(texts)
    full, m = minima(*shingles(hash_spans(w), w.off, k), perms)
    out = np.zeros((len(texts), perms), np.uint16)
    out[full] = np.maximum(mix(m.astype(np.uint64)).astype(np.uint16), 1)  # 0 is kept for texts without words
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places; two texts without words are alike (1), such a text and another are not (0)."""
    return (a == b).mean(axis=1) if len(a) else np.zeros(0)


def as_text(f: np.ndarray) -> list[str]:
    return ["" if not row[0] else base64.b64encode(row.astype("<u2").tobytes()).decode() for row in f]


def _deal(bounds: list[int], lowest: int):
    """Each document to the range of its id; the first of a range (and of the table) also to the end of the one before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds, np.int64)
        last = len(edges)
        for b in slices(batches, "text", 16 << 20):
            key = b.column("key").to_numpy()
            part = np.searchsorted(edges, key, "right").astype(np.int32)
            is_edge = np.isin(key, edges)
            lead = np.flatnonzero(is_edge | (key == lowest))
            back = np.where(is_edge[lead], part[lead] - 1, last).astype(np.int32)
            take = pa.array(np.concatenate([np.arange(b.num_rows), lead]))
            tail = np.concatenate([np.zeros(b.num_rows, bool), np.ones(len(lead), bool)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("text").take(take), b.column("key").take(take), pa.array(np.concatenate([part, back])), pa.array(tail)], names=["doc_id", "text", "key", "part", "tail"])

    return run


def _edit(k: int, perms: int):
    """Sorted rows of whole parts, each part closed by its tail rows; works slice by slice with one row carried over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in slices(batches, "text"):
            t = pa.Table.from_batches([*held, b]).combine_chunks().to_batches()[0]
            held = [t.slice(t.num_rows - 1, 1)]
            if t.num_rows > 1:
                yield from rows(t)

    def rows(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = [x or "" for x in t.column("text").to_pylist()]
        tail = np.array(t.column("tail").to_pylist())
        keep = np.flatnonzero(~tail[:-1])
        if not len(keep):
            return
        n = [len(x) for x in text]
        edited = [text[i][: n[i] - n[i] // 2] + text[i + 1][: n[i] // 2] for i in keep]
        own = fingerprint(pa.array(text, pa.large_string()), k, perms)
        new = fingerprint(pa.array(edited, pa.large_string()), k, perms)
        yield pa.RecordBatch.from_arrays(
            [
                t.column("doc_id").take(pa.array(keep)),
                pa.array([n[i] for i in keep], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(as_text(own[keep]), pa.string()),
                pa.array(as_text(new), pa.string()),
                pa.array(likeness(own[keep], new), pa.float64()),
                pa.array(likeness(own[keep], own[keep + 1]), pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return run


def fingerprints_with_edit(docs: DataFrame, k: int = SHINGLE, perms: int = PERMS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text keeps the first half and goes on with the next document's beginning, in ascending doc_id (nulls
    first, rows of one id by text); a table of one row is its own next.  A null text counts as empty and, like any text
    without words, has the empty fingerprint.  An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LOW)).alias("key"))
    low, rows = docs.agg(F.min("key"), F.count("*")).first()
    parts = min(MOST_PARTS, -(-rows // PART_ROWS))
    bounds = sorted({int(x) for x in _cuts(docs, parts)} - {low}) if parts > 1 else []
    dealt = docs.mapInArrow(_deal(bounds, low if low is not None else _LOW), "doc_id long, text string, key long, part int, tail boolean")
    ordered = dealt.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "tail", "key", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(_edit(k, perms), schema)


def _cuts(docs: DataFrame, parts: int) -> list[int]:
    """About equal ranges of ids, each beginning at an id that occurs.  Ids go through 32-bit halves, as the quantile
    sketch works on doubles: a range of very large ids may be less even, never wrong."""
    found = docs.approxQuantile("key", [i / parts for i in range(1, parts)], 0.25 / parts)
    wanted = sorted({int(x) for x in found})
    edges = np.array(wanted, np.int64)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, int] = {}
        for b in batches:
            key = b.column("key").to_numpy()
            at = np.searchsorted(edges, key, "right")
            for p in np.unique(at):
                x = int(key[at == p].min())
                low[int(p)] = min(low.get(int(p), x), x)
        yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int64()), pa.array(list(low.values()), pa.int64())], names=["p", "x"])

    rows = docs.select("key").mapInArrow(firsts, "p long, x long").groupBy("p").agg(F.min("x").alias("x")).collect()
    return [r["x"] for r in rows]


def _bands(k: int, bands: int, per: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
            _, m = minima(sets, off, bands * per)
            out = np.empty((len(m), bands), np.uint64)
            for j in range(bands):
                acc = np.full(len(m), j + 1, np.uint64)
                for c in range(per * j, per * (j + 1)):
                    acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + m[:, c])
                out[:, j] = acc
            return out

        for b in slices(batches, "text"):
            yield sketch_batch(b, k, False, keys)

    return run


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = 80, bands: int = 42, per_band: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: groups of documents linked by a Jaccard likeness of ``percent`` or more on
    ``k``-word shingles (a pair at 0.8 shares no band with a probability of 6e-8).  Edge cases as in minmax_dedup."""
    docs = docs.select("doc_id", "text")
    base = written(docs.mapInArrow(_bands(k, bands, per_band), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"))
    return link_groups(docs, base, full_sets(k, False), percent)
