"""Gapless numbering without a single-task window: counts per hash bucket, two levels of running totals, and a row
number inside each small bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.scratch import written

SPAN = 4096  # buckets under one upper-level total


def totals_before(df: DataFrame, key: str, place: str, value: str, span: int = 256) -> DataFrame:
    """``df`` (one row a (key, place), place a long from 0) with ``at``: the sum of ``value`` over the key's earlier
    places.  Two levels, so one key with most of the rows does not lie in one task."""
    df = written(df.withColumn("_s", F.floor(F.col(place) / span)))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    upper = df.groupBy(key, "_s").agg(F.sum(value).alias("_u"))
    upper = upper.select(F.col(key).alias("_k"), F.col("_s").alias("_t"), F.coalesce(F.sum("_u").over(earlier(key, "_s")), F.lit(0)).alias("_u"))
    lower = df.withColumn("_l", F.coalesce(F.sum(value).over(earlier(key, "_s", place)), F.lit(0)))
    both = lower.join(written(upper), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_s") == F.col("_t")))
    return both.withColumn("at", F.col("_u") + F.col("_l")).drop("_s", "_k", "_t", "_u", "_l")


def numbered(df: DataFrame, keys: list[str], order: Column, buckets: int, ties: list[str]) -> DataFrame:
    """``df`` with ``idx``: 0, 1, ... within ``keys``, in order of a hash bucket of ``order`` (a long), ``order``, ``ties``."""
    df = df.withColumn("_o", order).withColumn("_b", F.pmod("_o", F.lit(buckets)))
    count = written(df.groupBy(*keys, "_b").agg(F.count("*").alias("_n")).withColumn("_s", F.floor(F.col("_b") / SPAN)))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    upper = count.groupBy(*keys, "_s").agg(F.sum("_n").alias("_u"))
    upper = upper.select(*keys, "_s", F.coalesce(F.sum("_u").over(before(*(keys or [F.lit(0)]), "_s")), F.lit(0)).alias("_u"))
    lower = count.select(*keys, "_s", "_b", F.coalesce(F.sum("_n").over(before(*keys, "_s", "_b")), F.lit(0)).alias("_l"))
    start = written(lower.join(upper, [*keys, "_s"]).select(*keys, "_b", (F.col("_u") + F.col("_l")).alias("_from")))
    inside = Window.partitionBy(*keys, "_b").orderBy("_o", *ties)
    return df.join(start, [*keys, "_b"]).withColumn("idx", F.col("_from") + F.row_number().over(inside) - 1).drop("_o", "_b", "_from")
