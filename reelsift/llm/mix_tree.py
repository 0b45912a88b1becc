"""Mixing sources to target word counts by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by hash into blocks; a target of 1.4 times a source takes all its blocks once and the
first blocks (in hash order) again until the words are reached, cutting one document of a source at the mark.  The block
draws of all sources form an urn that a binary tree splits exactly among the output shards; each shard takes disjoint
permuted blocks of each source and is shuffled by a hash.  The driver sees one row per source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.numbering import totals_before
from reelsift.llm.scratch import small_table, written
from reelsift.llm.textkit import slices, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
ROWS_PER_BLOCK = 128
MOST_BLOCKS = 65_536
SHARDS = 16
POSITION_BITS = 6  # a shard's positions in so many powers of two of runs


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words per source: ``share`` of all words by weight, at most ``most`` times a source's own, excess dealt again."""
    out, left, todo = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while todo:
        total = sum(weights[i] for i in todo)
        over = {i for i in todo if left * weights[i] / total >= most * sizes[i]}
        if not over:
            for i in todo:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        todo -= over
    return out


def splitting_tree(draws: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block quotas: each node draws the left half's blocks without replacement from the urn."""
    if shards == 1:
        return draws[None, :]
    left = shards // 2
    take = rng.multivariate_hypergeometric(draws, int(draws.sum()) * left // shards) if len(draws) else draws
    return np.concatenate([splitting_tree(take, left, rng), splitting_tree(draws - take, shards - left, rng)])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(words(b.column("text")).count)], names=["doc_id", "source", "size"])


def _step(q: int) -> int:
    """A multiplier prime to q, so that i * step mod q is a permutation."""
    step = max(1, int(q * 0.6180339887)) | 1
    while math.gcd(step, max(q, 1)) != 1:
        step += 1
    return step


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """doc_id, source, rows (repeats of the row), size, source_size, target, taken, placements (copy, words, shard,
    position key), one row for each different (doc_id, source, size)."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", "text").mapInArrow(_sizes, "doc_id long, source string, size long")
    sized = written(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")))
    found = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("total"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goal = targets([r["total"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    info = []
    for r, t in zip(found, goal, strict=True):
        full = min(int(t // r["total"]), most) if r["total"] else 0
        blocks = min(MOST_BLOCKS, max(1, math.ceil(r["n"] / ROWS_PER_BLOCK)))
        info.append((r["source"], r["total"], float(t), full, round(t) - full * r["total"], blocks))
    per = small_table(spark, info, "src string, source_size long, target double, full long, extra long, blocks long")
    per = F.broadcast(per) if len(info) <= 100_000 else per

    order = F.xxhash64("doc_id", F.lit(seed))
    base = sized.join(per, F.col("source").eqNullSafe(F.col("src"))).drop("src").withColumn("block", F.pmod(order, F.col("blocks")))
    base = base.withColumn("w", F.col("size") * F.col("rows"))
    block = base.groupBy("source", "block").agg(F.sum("w").alias("bw"), F.first("extra").alias("extra"), F.first("full").alias("full"), F.first("blocks").alias("blocks"))
    block = written(totals_before(block, "source", "block", "bw"))
    again = {r["source"]: r["m"] for r in block.where("at < extra").groupBy("source").agg((F.max("block") + 1).alias("m")).collect()}

    draws = np.array([i[3] * i[5] + again.get(i[0], 0) for i in info], np.int64)
    quota = splitting_tree(draws, shards, np.random.default_rng(seed)).T if len(info) else np.zeros((0, shards), np.int64)
    bounds = [(i[0], [int(x) for x in np.concatenate([[0], np.cumsum(q)[:-1]])], int(max(1, d)), _step(int(d))) for i, q, d in zip(info, quota, draws, strict=True)]
    cut = small_table(spark, bounds, "src string, bounds array<long>, draws long, step long")
    cut = F.broadcast(cut) if len(info) <= 100_000 else cut

    where = block.select(F.col("source").alias("s"), F.col("block").alias("b"), "at")
    rows = base.join(where, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("source", "block").orderBy(order, "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("pos", F.col("at") + F.coalesce(F.sum("w").over(inside), F.lit(0)))
    more = F.floor(F.greatest(F.lit(0), F.least(F.col("w"), F.col("extra") - F.col("pos"))) / F.col("rows"))
    rows = rows.withColumn("more", more).join(cut, F.col("source").eqNullSafe(F.col("src"))).drop("src")

    def place(copy):
        draw = F.pmod((copy * F.col("blocks") + F.col("block")) * F.col("step"), F.col("draws"))
        shard = F.size(F.filter("bounds", lambda e: e <= draw)) - 1
        part = F.when(copy < F.col("full"), F.col("size")).otherwise(F.col("more"))
        return F.struct(copy.cast("int").alias("copy"), part.alias("words"), shard.cast("int").alias("shard"), F.xxhash64("doc_id", copy, F.lit(seed + 1)).alias("position"))

    copies = F.when(F.col("full") + (F.col("more") > 0).cast("long") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("full") + (F.col("more") > 0).cast("long") - 1), place))
    taken = F.col("full") * F.col("size") + F.col("more")
    return rows.select("doc_id", "source", "rows", "size", "source_size", "target", taken.alias("taken"), copies.alias("placements"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, size, source_size, target, taken and its placements.

    Null texts have size 0 and are taken with 0 words; null sources form the last source.  Rows with equal doc_id,
    source and size share alike.  Empty tables give no rows.
    """
    plan = mix_plan(docs, **options).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken", F.coalesce("placements", F.array()).alias("placements"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with the columns of ``docs``; a document cut at a
    source's mark keeps its first words (joined by one space).  Partitions hold whole runs of a shard's positions, in order.  Rows that share a doc_id (or have none) are taken each by
    the plan of their own length; those of equal doc_id, source and length share alike."""
    plan = mix_plan(docs, **options).select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_size"), F.explode("placements").alias("_p"))
    plan = written(plan)
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")  # as textkit counts words
    both = docs.withColumn("_n", size).join(plan, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_n") == F.col("_size")))
    tokens = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    text = F.when(F.col("_p.words") < F.col("_size"), F.concat_ws(" ", F.slice(tokens, 1, F.greatest(F.lit(1), F.col("_p.words")).cast("int")))).otherwise(F.col("text"))
    # dealt as the tree drew it: runs of one shard and one range of positions, each in the order of its shuffle
    shard, span = F.col("_p.shard"), F.shiftright("_p.position", 64 - POSITION_BITS)
    dealt = both.withColumn("text", text).repartition(shard, span).sortWithinPartitions(shard, "_p.position")
    return dealt.select(*docs.columns)
