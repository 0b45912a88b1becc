"""Near-duplicate groups by min-max hashing.

Each document's distinct word shingles go through ``3 * bands`` universal hash permutations; a band is the minimum
*and* the maximum under three of them, so half the hash evaluations give six values a band.  With 46 bands a pair of
Jaccard 0.8 shares no band with a probability of about 1e-6 (1e-5 for sets of a handful of shingles).

Equal sets collapse first, a bucket is linked through one leader, and only what a leader leaves apart is compared
further, across components, so a huge group of copies never becomes all its pairs.  That comparison meets rows at rare
shingles within exact size bounds, so a family just under the threshold makes no pairs either.
Every link is confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.linking import full_sets, link_groups, sketch_batch
from reelsift.llm.scratch import written
from reelsift.llm.textkit import mix, slices

BANDS = 46
PERMS_PER_BAND = 3
SEED = 11


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def minmax_signature(sets: np.ndarray, starts: np.ndarray, perms: int) -> np.ndarray:
    """(texts, 2 * perms): minimum and maximum of each permutation over each non-empty set."""
    a, b = _permutations(perms)
    out = np.empty((2 * perms, len(starts)), np.uint64)
    if not len(starts):
        return out.T
    for p in range(perms):
        v = sets * a[p]
        v += b[p]
        v >>= np.uint64(32)
        out[2 * p] = np.minimum.reduceat(v, starts)
        out[2 * p + 1] = np.maximum.reduceat(v, starts)
    return out.T


def _sketch(k: int, bands: int, per: int):
    def keys(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
        sig = minmax_signature(sets, off[:-1][np.diff(off) > 0], bands * per)
        out = np.empty((len(sig), bands), np.uint64)
        for j in range(bands):
            acc = np.full(len(sig), j + 1, np.uint64)
            for c in range(2 * per * j, 2 * per * (j + 1)):
                acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + sig[:, c])
            out[:, j] = acc
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield sketch_batch(b, k, True, keys)

    return run


def near_duplicates(docs: DataFrame, k: int = 2, percent: int = 80, bands: int = BANDS, per_band: int = PERMS_PER_BAND) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; other columns are ignored).

    Null and wordless texts have no shingles and link with nothing.  Rows that repeat a doc_id count as copies: each
    gives a row.  A null doc_id links with nothing, has a null component and is kept.  An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    base = written(docs.mapInArrow(_sketch(k, bands, per_band), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"))
    return link_groups(docs, base, full_sets(k, True), percent)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that stay: of each group the row of its smallest doc_id.  Of rows that repeat a kept doc_id one
    stays, rows without doc_id all stay."""
    groups = written(near_duplicates(docs, **options).where("doc_id is not null").select("doc_id", "kept"))
    often = written(groups.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    out = written(groups.where("not kept").select("doc_id").distinct())
    if often.isEmpty():
        return docs.join(out, "doc_id", "left_anti").select(docs.columns)
    single = docs.join(out.unionByName(often).distinct(), "doc_id", "left_anti").select(docs.columns)
    one = docs.join(often.join(out, "doc_id", "left_anti"), "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return single.unionByName(one)
