"""Bounded hash samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def smallest(df: DataFrame, order: Column, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows of smallest ``order`` (a 64-bit hash).  Rows that can't be among them are left out before the
    sort (twice ``n`` pass on average), so what tasks send to the driver together doesn't grow with their number."""
    rows = df.count()
    if rows > 2 * n:
        df = df.where(order <= int(-(2**63) + 2 * n / rows * 2**64))
    return df.orderBy(order, *ties).limit(n)
