"""Exact per-key row positions without putting a hot key in one task.

Window functions partitioned by a key (the user) need all of that key's rows
in one task, and AQE cannot split a window partition.  When one key holds a
large share of the rows we instead:

1. detect the heavy keys with a count aggregate (partial, skew-safe; at most
   rows / heavy_rows keys can exceed the threshold, so the list is bounded);
2. range-partition only the heavy keys' rows by (key, order...) -- Spark's
   range partitioner samples the key space, so one key is spread over many
   partitions -- and sort within partitions;
3. number rows per key inside each partition (one pass, ``mapInPandas``) and
   checkpoint the result to the shared checkpoint folder (stable partition
   ids, lineage cut, survives executor loss);
4. add, for keys that cross partition boundaries, the rows in earlier
   partitions: only a partition's first and last key can cross, so the offset
   table has at most 2 rows per partition and is broadcast.

``blocks`` then cuts the positioned rows into blocks of ``block_rows`` and
copies the last ``context`` rows of each block into the next one, so a
bounded window (``rowsBetween(-context, -1)``) over (key, block) gives exactly
the same answer as over the whole key, with every task bounded.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.session import checkpoint_base

HEAVY_ROWS = 2_000_000  # a key with more rows than this leaves the plain window path
BLOCK_ROWS = 500_000  # rows per block (plus the copied context) for heavy keys


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> list[tuple]:
    """(key, rows) of every key with more than ``heavy_rows`` rows.

    A count aggregate with a map-side partial; the answer has at most
    rows / heavy_rows entries, so fetching it is bounded by construction.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [(r[key], r["_n"]) for r in counts.where(F.col("_n") > heavy_rows).collect()]


def split_heavy(df: DataFrame, key: str, heavy: list[tuple]):
    """(light rows, heavy rows, heavy key frame) for a non-empty heavy list."""
    spark = df.sparkSession
    key_type = df.schema[key].dataType
    hdf = F.broadcast(spark.createDataFrame(heavy, T.StructType([T.StructField(key, key_type), T.StructField("_n", T.LongType())])))
    return df.join(hdf.select(key), key, "left_anti"), df.join(hdf.select(key), key, "left_semi"), hdf


def _local_index_fn(key: str):
    def fn(batches):
        pid = TaskContext.get().partitionId()
        carry_key, carry_n = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf[key].to_numpy()
            starts = np.empty(len(k), dtype=bool)
            starts[0] = True
            starts[1:] = k[1:] != k[:-1]
            run = np.cumsum(starts) - 1
            first = np.flatnonzero(starts)
            li = np.arange(len(k), dtype=np.int64) - first[run]
            if carry_key is not None and k[0] == carry_key:
                li[run == 0] += carry_n
            # the last run may continue in the next batch: li already holds any carried offset
            carry_key, carry_n = k[-1], int(li[-1]) + 1
            yield pdf.assign(_pid=np.int32(pid), _li=li)

    return fn


def heavy_positions(df: DataFrame, key: str, order: list[str], total_rows: int, rows_per_partition: int = BLOCK_ROWS) -> DataFrame:
    """``df`` (heavy keys only) with ``pos``: 0-based position of each row
    within its key in ``order`` (order must make rows unique within a key)."""
    checkpoint_base(df.sparkSession)  # checkpoint() below needs the shared folder registered
    n_parts = max(1, math.ceil(total_rows / rows_per_partition))
    ranged = df.repartitionByRange(n_parts, key, *order).sortWithinPartitions(key, *order)
    schema = T.StructType(list(df.schema.fields) + [T.StructField("_pid", T.IntegerType()), T.StructField("_li", T.LongType())])
    local = ranged.mapInPandas(_local_index_fn(key), schema).checkpoint(eager=True)
    bounds = local.groupBy(F.col("_pid").alias("_bpid")).agg(F.min(key).alias("_kmin"), F.max(key).alias("_kmax"))
    edge = local.join(
        F.broadcast(bounds),
        (local["_pid"] == bounds["_bpid"]) & ((local[key] == bounds["_kmin"]) | (local[key] == bounds["_kmax"])),
    )
    counts = edge.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(key, "_pid", before.cast("bigint").alias("_before"))
    out = local.join(F.broadcast(offsets), [key, "_pid"], "left")
    return out.withColumn("pos", F.col("_li") + F.coalesce("_before", F.lit(0))).drop("_pid", "_li", "_before")


def blocks(positioned: DataFrame, block_rows: int, context: int) -> DataFrame:
    """Own rows tagged with their block, plus copies of each block's last
    ``context`` rows tagged with the next block (``_ctx`` true)."""
    if block_rows < context:
        raise ValueError("block_rows must be at least the window context")
    blk = F.floor(F.col("pos") / block_rows)
    own = positioned.withColumn("_block", blk).withColumn("_ctx", F.lit(False))
    tail = positioned.where(F.col("pos") % block_rows >= block_rows - context)
    ctx = tail.withColumn("_block", blk + 1).withColumn("_ctx", F.lit(True))
    return own.unionByName(ctx)
