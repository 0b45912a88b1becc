"""Running totals over an ordered value column without a single-task window.

A window ``ORDER BY v`` with no partition runs in one task.  Here the rows
(one per distinct value) are cut into value ranges from Spark's quantile
sketch: each range's total comes from a tiny aggregate (one row per range,
broadcast), and the running sum inside a range is a window partitioned by
the range.  Every task holds at most about ``rows_per_range`` rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.session import written

ROWS_PER_RANGE = 1_000_000


def running_totals(per_value: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order_col`` order) and
    ``total_<c>`` for each ``c`` in ``sum_cols``.

    ``per_value`` must hold one row per distinct ``order_col`` value (equal
    values must not be split across ranges; ranges are cut on values).
    """
    per_value = written(per_value)  # counted, cut into ranges and summed, but derived once
    n = per_value.count()
    ranges = max(1, math.ceil(n / rows_per_range))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if ranges == 1:  # rows_per_range rows at most: one window, no range table
        upto = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(F.lit(0))
        return per_value.select(
            *per_value.columns,
            *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sum_cols],
            *[F.sum(c).over(whole).alias(f"total_{c}") for c in sum_cols],
        )
    probs = [i / ranges for i in range(1, ranges)]
    splits = sorted(set(per_value.approxQuantile(order_col, probs, 1.0 / (4 * ranges))))
    below = F.size(F.filter(F.array(*[F.lit(x) for x in splits]), lambda s: s < F.col(order_col)))
    rng = (F.lit(len(splits)) - below) if descending else below
    tagged = per_value.withColumn("_r", rng.cast("int"))
    range_tot = tagged.groupBy("_r").agg(*[F.sum(c).alias(f"_rt_{c}") for c in sum_cols])
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    range_tot = range_tot.select(
        "_r",
        *[F.coalesce(F.sum(f"_rt_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sum_cols],
        *[F.sum(f"_rt_{c}").over(everything).alias(f"total_{c}") for c in sum_cols],
    )
    within = Window.partitionBy("_r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = tagged.join(F.broadcast(range_tot), "_r")  # at most `ranges` rows, by construction
    return joined.select(
        *per_value.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(within)).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"total_{c}") for c in sum_cols],
    )
