"""item2vec whose vocabulary is spread over the cluster (E1, E2, E5): skip-gram with negative sampling by blocks of items.

Spark ML's Word2Vec holds all vectors on the driver and in every task.  Here they stay a table: items are hashed into
blocks, and the co-occurrence counts into cells (block of the centre, block of the context).  A round trains the cells
(i, i + s) for one shift s side by side; no two of them share a block, so each task holds just its two blocks and its
cell, and the rounds of all shifts make an epoch.  Every round reads the vectors of the last one from the shared
checkpoint folder, so a lost executor repeats one cell.

Counts instead of single pairs keep a hot item small: however many rows name it, it has at most one count per partner,
and a cell never has more rows than the square of a block.  The draws of a cell come from a generator seeded by (seed, epoch, shift, cell)
over rows in id order, so the vectors are equal on any cluster and any layout of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions import dot
from reelsift.operators.embedding import ITEM2VEC_DIM, ITEM2VEC_WINDOW, SENTENCE_ITEMS
from reelsift.session import removed, written, written_at

BLOCK_ITEMS = 4096  # items of a block, as long as there are no more than ROUND_BLOCKS of them
ROUND_BLOCKS = 24  # blocks, and so rounds of an epoch, beyond which blocks grow instead
CELL_PAIRS = 4_000_000  # counts of a cell on average, and
MOST_BLOCK_ITEMS = 400_000  # items of a block, at most: what a task holds
TASKS_A_CELL = 3  # partitions of a round for each cell: few cells share one by their hash
NEGATIVE = 5  # drawn contexts a pair
EPOCHS = 5
PASSES = 2  # over a cell while its blocks are at hand: ten passes in all, like ITEM2VEC_ITERATIONS
RATE = 0.3  # of Adagrad, one accumulator a vector
BATCH = 512  # pairs of a step, at most
TILE = 128  # centres and contexts that meet beside them
PIECE_ITEMS, PIECE_PAIRS = 16_384, 262_144  # items, or counts, of a packed row
TILES_AT_ONCE = 4  # tiles whose products are held (256 kB in single precision)
MIN_COUNT = 5
POWER = 0.75  # contexts are drawn in proportion to count ** POWER
POWER_UNIT = 1024  # the powers are kept as whole numbers of 1 / POWER_UNIT, so that sums are exact in any order

_STATE = "side int, block int, part int, n binary, p binary, vec binary, acc binary"


def cooccurrence(sequences: DataFrame, window: int = ITEM2VEC_WINDOW, min_count: int = MIN_COUNT, max_len: int = SENTENCE_ITEMS) -> DataFrame:
    """(item_a <= item_b, n bigint): how near and how often two items follow each other in ``item_sequences``.

    Items seen fewer than ``min_count`` times leave first, as Word2Vec does.  Two items d places apart (d <= window) in a
    piece of at most ``max_len`` places count window + 1 - d: the expected count, times ``window``, of Word2Vec's random
    window.  Null items are left out.
    """
    kept = sequences.where(F.col("item_id").isNotNull())
    often = kept.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("item_id")
    cut = kept.join(often, "item_id", "left_semi").withColumn("chunk", F.floor(F.col("pos") / max_len))
    piece = cut.groupBy("user_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "item_id")))["item_id"].alias("items"))
    near = F.transform("items", lambda x, i: F.struct(x.alias("a"), F.slice("items", i + 2, F.lit(window)).alias("after")))
    pair = piece.select(F.explode(near).alias("r")).select(F.col("r.a").alias("a"), F.posexplode("r.after").alias("d", "b"))
    pair = pair.select(F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b"), (window - F.col("d")).cast("bigint").alias("n"))
    return pair.groupBy("item_a", "item_b").agg(F.sum("n").alias("n"))


def _adagrad(vec: np.ndarray, acc: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """One step, in place: the columns of ``vec`` named in ``rows`` go against their summed gradients."""
    total = np.empty_like(vec)
    for k in range(len(vec)):
        total[k] = np.bincount(rows, grad[k], vec.shape[1])
    acc += np.einsum("ij,ij->j", total, total) / len(vec)
    vec -= total * (rate / np.sqrt(acc + 1e-12)).astype(vec.dtype)


def _dealt(own: np.ndarray, draws: int, rng) -> np.ndarray:
    """``draws`` rows in random order, each as often as its part of ``own`` but for less than one."""
    upto = np.minimum(np.floor(np.cumsum(own) * (draws / float(own.sum())) + rng.random()).astype(np.int64), draws)
    upto[-1] = draws
    return rng.permutation(np.repeat(np.arange(len(own)), np.diff(upto, prepend=0)))


def train_cell(centre, context, centre_acc, context_acc, a, b, n, centre_n, context_p, all_p, rng,
               negative: int = NEGATIVE, passes: int = PASSES, rate: float = RATE, batch: int = BATCH, tile: int = TILE) -> None:
    """Train two blocks of vectors on their cell, in place.

    ``a``, ``b``, ``n``: rows of the centre and context block and their counts.  The loss is that of skip-gram with
    ``negative`` drawn contexts a pair: a centre with count N meets contexts of this block with a weight of
    negative x N x (its part of ``all_p``), also where the cell has no pair.  ``batch`` pairs take their share of that
    weight: blocks of at most ``tile`` items meet whole, with the expected weights; of larger ones ``tile`` centres and
    ``tile`` contexts are drawn in proportion to their weights, and all of the former meet all of the latter.  A step
    takes as many batches, with a tile each, as the smaller block holds times ``batch`` items: an item is met about once.
    """
    if not len(centre_n) or not len(context_p):
        return
    mass = negative * float(centre_n.sum()) * float(context_p.sum()) / float(all_p)
    weight = n.astype(centre.dtype)
    tiles = max(1, min(len(centre_n), len(context_p)) // batch)
    # a cell without pairs, or with few, has a batch for the items of its centre block all the same
    steps = -(-max(1, -(-len(a) // batch), -(-len(centre_n) // batch)) // tiles)

    def drawn(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of each step's tiles, and the weight of each in its tile."""
        if len(own) <= tile:
            return np.broadcast_to(np.arange(len(own)), (steps, tiles, len(own))), (own / float(own.sum())).astype(centre.dtype)
        return _dealt(own, steps * tiles * tile, rng).reshape(steps, tiles, tile), np.full(tile, 1 / tile, centre.dtype)

    def part(m: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(tiles, items, places) of the rows' vectors."""
        return np.ascontiguousarray(np.take(m, rows, axis=1).transpose(1, 2, 0))

    def both(near: np.ndarray, g: np.ndarray, far: np.ndarray) -> np.ndarray:
        """The gradients of a step's pairs and of its tiles, places first."""
        out = np.empty((len(near), len(g) + far.shape[0] * far.shape[1]), near.dtype)
        np.multiply(near, g, out=out[:, : len(g)])
        out[:, len(g) :] = far.reshape(-1, far.shape[2]).T
        return out

    # places first: a step's work runs along the items
    u_all, v_all = np.ascontiguousarray(centre.T), np.ascontiguousarray(context.T)
    for _ in range(passes):
        order = rng.permutation(len(a))
        (far_rows, row_part), (far_cols, col_part) = drawn(centre_n), drawn(context_p)
        share = (row_part * (mass / steps / tiles))[:, None] * col_part
        for step in range(steps):
            o = np.sort(order[step * len(a) // steps : (step + 1) * len(a) // steps])  # rows in turn lie together
            rows, cols = a[o].astype(np.intp), b[o].astype(np.intp)
            u, v = np.take(u_all, rows, axis=1, mode="clip"), np.take(v_all, cols, axis=1, mode="clip")  # clip: none to check
            g = (1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->j", u, v), -30, 30))) - 1) * weight[o]
            far_u, far_v = part(u_all, far_rows[step]), part(v_all, far_cols[step])
            u_grad, v_grad = np.empty_like(far_u), np.empty_like(far_v)
            for t in range(0, tiles, TILES_AT_ONCE):
                now = slice(t, t + TILES_AT_ONCE)
                h = far_u[now] @ far_v[now].transpose(0, 2, 1)
                with np.errstate(over="ignore"):  # beyond the largest number the quotient is 0, as it should be
                    np.exp(np.negative(h, out=h), out=h)
                h += 1
                np.divide(share, h, out=h)
                u_grad[now], v_grad[now] = h @ far_v[now], h.transpose(0, 2, 1) @ far_u[now]
            _adagrad(u_all, centre_acc, np.concatenate([rows, far_rows[step].ravel()]), both(v, g, u_grad), rate)
            _adagrad(v_all, context_acc, np.concatenate([cols, far_cols[step].ravel()]), both(u, g, v_grad), rate)
    centre[:], context[:] = u_all.T, v_all.T


def _packed(column) -> pa.Array:
    """One row with all values of a column, as bytes."""
    return pa.array([np.ascontiguousarray(column).tobytes()], pa.binary())


def _unpacked(rows: pa.Table, column: str, dtype) -> np.ndarray:
    """The values of all rows, one after the other."""
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), dtype).copy()


def _pieces(keys: dict[str, int], columns: dict[str, np.ndarray], size: int) -> pa.Table:
    """``columns`` (of one length) as rows of at most ``size`` values: the keys, ``part`` and bytes."""
    length = len(next(iter(columns.values())))
    tables = []
    for part, at in enumerate(range(0, length, size)):
        fixed = {k: pa.array([v], pa.int32()) for k, v in (keys | {"part": part}).items()}
        tables.append(pa.table(fixed | {k: _packed(v[at : at + size]) for k, v in columns.items()}))
    fixed = {k: pa.array([], pa.int32()) for k in (*keys, "part")}
    return pa.concat_tables(tables) if tables else pa.table(fixed | {k: pa.array([], pa.binary()) for k in columns})


def _pack_block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A block's items of one side in id order."""
    rows = rows.sort_by("item_id")
    vec = rows.column("vec").combine_chunks()
    vec = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(rows), -1)
    columns = {c: rows.column(c).to_numpy() for c in ("item_id", "n", "p")}
    return _pieces({"side": key[0].as_py(), "block": key[1].as_py()}, columns | {"vec": vec, "acc": np.zeros(len(rows))}, PIECE_ITEMS)


def _pack_cell(key: tuple[pa.Scalar, ...], pairs: pa.Table, ids: pa.Table) -> pa.Table:
    """A cell's counts, each named by the places of its items in their blocks, in the order of places."""
    ids = ids.sort_by("part")
    first, second = (_unpacked(ids.filter(pa.array(ids.column("side").to_numpy() == side)), "item_id", np.int64) for side in (0, 1))
    a, b = np.searchsorted(first, pairs.column("a").to_numpy()), np.searchsorted(second, pairs.column("b").to_numpy())
    order = np.argsort(a * max(1, len(second)) + b)  # no two are equal
    columns = {"a": a[order].astype(np.int32), "b": b[order].astype(np.int32), "n": pairs.column("n").to_numpy()[order]}
    return _pieces({"shift": key[0].as_py(), "cell": key[1].as_py()}, columns, PIECE_PAIRS)


def _cell_fn(dim: int, all_p: int, seed: int, epoch: int, shift: int, negative: int, passes: int, rate: float, batch: int):
    def block(rows: pa.Table, side: int):
        rows = rows.filter(pa.array(rows.column("side").to_numpy() == side)).sort_by("part")
        n, p = (_unpacked(rows, c, np.int64) for c in ("n", "p"))
        return (rows.column("block")[0].as_py() if len(rows) else 0), n, p, _unpacked(rows, "vec", np.float32).reshape(-1, dim), _unpacked(rows, "acc", np.float64)

    def fn(key, pairs: pa.Table, rows: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        (i, n, p, u, ua), (j, xn, xp, v, va) = block(rows, 0), block(rows, 1)
        pairs = pairs.sort_by("part")
        a, b, count = (_unpacked(pairs, c, t) for c, t in (("a", np.int32), ("b", np.int32), ("n", np.int64)))
        rng = np.random.default_rng([seed & 0x7FFFFFFF, epoch, shift, cell])
        train_cell(u, v, ua, va, a, b, count, n, xp, all_p, rng, negative, passes, rate, batch)
        return pa.concat_tables([
            _pieces({"side": 0, "block": i}, {"n": n, "p": p, "vec": u, "acc": ua}, PIECE_ITEMS), _pieces({"side": 1, "block": j}, {"n": xn, "p": xp, "vec": v, "acc": va}, PIECE_ITEMS)
        ])

    return fn


def _vectors_fn(dim: int):
    def lists(flat: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim, dtype=np.int32)), pa.array(flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, n = (pa.array(np.frombuffer(row[c], np.int64)) for c in ("item_id", "n"))
                yield pa.RecordBatch.from_arrays([ids, n, *(lists(np.frombuffer(row[c], np.float32)) for c in ("emb", "context"))], names=["item_id", "n", "emb", "context"])

    return run


def block_count(items: int, pairs: int, block_items: int = BLOCK_ITEMS, least: int = 1) -> int:
    """Blocks for ``items`` and ``pairs`` (of both directions), at least ``least`` as far as there are items.

    An epoch has as many rounds as blocks, and every cell draws for each item of its centre block: with blocks of a fixed
    size rounds and draws would grow with the square of the items.  So blocks grow beyond ROUND_BLOCKS of them, until a
    cell or its two blocks reach what a task may hold.
    """
    few = min(math.ceil(items / block_items), ROUND_BLOCKS)
    return max(1, min(least, items), few, math.ceil(items / MOST_BLOCK_ITEMS), min(math.ceil(math.sqrt(pairs / CELL_PAIRS)), math.ceil(items / block_items)))


def first_vector(dim: int, seed: int, side: int = 0) -> Column:
    """An item's vector before training: hashes of (item, side, place) in (-1/2, 1/2) / dim."""
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: (
        (F.pmod(F.xxhash64("item_id", F.lit(side), k, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20) - 0.5) / dim).cast("float"))


def train_item2vec_blocks(
    pairs: DataFrame,
    dim: int = ITEM2VEC_DIM,
    seed: int = 42,
    block_items: int = BLOCK_ITEMS,
    epochs: int = EPOCHS,
    negative: int = NEGATIVE,
    passes: int = PASSES,
    rate: float = RATE,
    batch: int = BATCH,
    least_blocks: int = 1,
) -> DataFrame:
    """(item_id, n, emb ARRAY<FLOAT>, context ARRAY<FLOAT>) of every item of ``cooccurrence`` pairs.

    ``n``: the item's count over all partners.  The driver holds two numbers (items, sum of powers); the rounds are
    epochs x blocks jobs, whose tables lie in the shared checkpoint folder.  No pairs: an empty table.
    """
    spark = pairs.sparkSession
    pairs = written(pairs.select("item_a", "item_b", "n"))
    both = F.explode(F.array(F.struct(F.col("item_a").alias("a"), F.col("item_b").alias("b")), F.struct(F.col("item_b").alias("a"), F.col("item_a").alias("b"))))
    directed = pairs.select(both.alias("r"), "n").select("r.a", "r.b", "n")
    power = F.greatest(F.round(F.pow(F.col("n").cast("double"), F.lit(POWER)) * POWER_UNIT).cast("bigint"), F.lit(1))
    items = written(directed.groupBy(F.col("a").alias("item_id")).agg(F.sum("n").alias("n")).withColumn("p", power))
    count, all_p = items.agg(F.count(F.lit(1)), F.sum("p")).first()
    blocks = block_count(count, 2 * pairs.count(), block_items, least_blocks)
    block = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(seed)), F.lit(blocks)).cast("int")
    whole = lambda c, n: F.pmod(c, F.lit(n)).cast("int")

    # a block is a few rows of bytes, its items in id order: rounds move those, not a row an item
    side = lambda s: items.select(F.lit(s).alias("side"), block("item_id").alias("block"), "item_id", "n", "p", first_vector(dim, seed, s).alias("vec"))
    first = written(side(0).unionByName(side(1)).groupBy("side", "block").applyInArrow(_pack_block, _STATE + ", item_id binary"))
    ids = first.where("side = 0").select("block", "part", "item_id")

    # a cell is its mirror read the other way round: only shifts of up to half of the blocks are kept
    half = blocks // 2
    cells = directed.select("a", "b", "n", block("a").alias("cell"), block("b").alias("to")).withColumn("shift", whole(F.col("to") - F.col("cell"), blocks))
    cells = cells.where(F.col("shift") <= half).select("shift", "cell", "a", "b", "n")
    at = ids.withColumn("shift", F.explode(F.sequence(F.lit(0), F.lit(half)))).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    at = at.select("shift", whole(F.when(F.col("side") == 0, F.col("block")).otherwise(F.col("block") - F.col("shift")), blocks).alias("cell"), "side", "part", "item_id")
    tasks = (half + 1) * blocks
    packed = cells.repartition(tasks, "shift", "cell").groupBy("shift", "cell").cogroup(at.repartition(tasks, "shift", "cell").groupBy("shift", "cell"))
    cells = written(packed.applyInArrow(_pack_cell, "shift int, cell int, part int, a binary, b binary, n binary"), "shift")

    state, path = first.drop("item_id"), None
    if count:
        for epoch in range(epochs):
            for shift in range(blocks):
                home = whole(F.when(F.col("side") == 0, F.col("block")).otherwise(F.col("block") - F.lit(shift)), blocks)
                if shift <= half:
                    now = cells.where(F.col("shift") == shift).select("part", "a", "b", "n", "cell")
                else:
                    now = cells.where(F.col("shift") == blocks - shift).select("part", F.col("b").alias("a"), F.col("a").alias("b"), "n", whole(F.col("cell") - F.lit(shift), blocks).alias("cell"))
                # a given number of partitions: small cells would be put together and train one after the other
                now = now.repartition(TASKS_A_CELL * blocks, "cell").groupBy("cell")
                fn = _cell_fn(dim, int(all_p), seed, epoch, shift, negative, passes, rate, batch)
                old, (state, path) = path, written_at(now.cogroup(state.withColumn("cell", home).repartition(TASKS_A_CELL * blocks, "cell").groupBy("cell")).applyInArrow(fn, _STATE))
                if old:
                    removed(spark, old)  # read by this round only
    one = lambda s, name: state.where(F.col("side") == s).select("block", "part", "n", F.col("vec").alias(name))
    vectors = ids.join(one(0, "emb"), ["block", "part"]).join(one(1, "context").drop("n"), ["block", "part"])
    return vectors.select("item_id", "n", "emb", "context").mapInArrow(_vectors_fn(dim), "item_id bigint, n bigint, emb array<float>, context array<float>")


def product_gap(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row (met, unmet): the mean product of centre and context over the ``pairs``, and that of items drawn
    independently, both in proportion to their counts (the latter from the mean vectors, without any pair)."""
    e = vectors.select(F.col("item_id"), F.col("emb").cast("array<double>").alias("emb"), F.col("context").cast("array<double>").alias("context"))
    one = lambda s: e.select(F.col("item_id").alias(f"item_{s}"), F.col("emb").alias(f"emb_{s}"), F.col("context").alias(f"context_{s}"))
    joined = pairs.join(one("a"), "item_a").join(one("b"), "item_b")
    product = dot(F.col("emb_a"), F.col("context_b")) + dot(F.col("emb_b"), F.col("context_a"))
    met = joined.agg((F.sum(product * F.col("n")) / F.sum(F.col("n") * 2)).alias("met"))
    mean = lambda c: Summarizer.mean(array_to_vector(c), F.col("n").cast("double"))
    means = vectors.select("n", F.col("emb").cast("array<double>").alias("emb"), F.col("context").cast("array<double>").alias("context"))
    means = means.agg(vector_to_array(mean(F.col("emb"))).alias("u"), vector_to_array(mean(F.col("context"))).alias("v"))
    return met.join(F.broadcast(means.select(dot(F.col("u"), F.col("v")).alias("unmet"))))  # one row each
