"""Labels, filters, the rating distribution, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.functions import POSITIVE_THRESHOLD, label, uniform
from reelsift.operators.cumulative import ROWS_PER_RANGE, running_totals


def add_label(ratings: DataFrame, threshold: float = POSITIVE_THRESHOLD) -> DataFrame:
    """``label`` = 1 when rating >= threshold, else 0."""
    return ratings.withColumn("label", label("rating", threshold))


def filter_positive(ratings: DataFrame, threshold: float = POSITIVE_THRESHOLD) -> DataFrame:
    """Keep liked ratings (pushed into the scan when ratings is a file)."""
    return ratings.where(F.col("rating") >= threshold)


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """A1 + A15: count per rating value and its share of all ratings.

    One aggregation over the ratings; the total comes from the range-bucketed
    running totals over the (few) distinct values, so no unpartitioned window.
    """
    counts = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    tot = running_totals(counts, "rating", ["n"])
    return tot.select("rating", F.col("n").alias("rating_count"), (F.col("n") / F.col("total_n")).alias("percentage"))


def sample_rows(df: DataFrame, fraction: float, seed: int, keys=("user_id", "item_id"), method: str = "hash") -> DataFrame:
    """Bernoulli sample.

    ``method="hash"`` (default): keep rows whose md5-derived uniform of
    ``keys`` and the seed is below ``fraction`` -- deterministic and the same
    in any engine, so it can be checked exactly.  ``method="native"``:
    ``df.sample(fraction, seed)`` -- Spark's per-partition sampler; fast, but
    its draw depends on the partitioning.
    """
    if method == "native":
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(uniform(*keys, seed=seed) < fraction)


def random_split(df: DataFrame, train_fraction: float, seed: int, keys=("user_id", "item_id"),
                 method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """train/test split, disjoint and complete.

    ``method="hash"``: on a hash uniform of ``keys`` (independent of the
    sampling draw); ``method="native"``: ``df.randomSplit``.
    """
    if method == "native":
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
        return train, test
    u = uniform(*keys, seed=seed + 1)
    return df.where(u < train_fraction), df.where(u >= train_fraction)


def time_split_point(df: DataFrame, quantile: float = 0.8, relative_error: float = 0.05, ts_col: str = "ts",
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """X3 split point as a one-row frame ``split_ts``.

    ``relative_error > 0``: Spark's Greenwald-Khanna sketch
    (``percentile_approx``, accuracy 1/relative_error), merged map-side.
    ``relative_error == 0``: the exact lower quantile (``percentile_disc``
    semantics: smallest value whose cumulative share reaches ``quantile``),
    computed from per-value counts with range-bucketed running totals, so no
    task ever holds all the rows or all the distinct values.
    """
    if relative_error > 0:
        return df.agg(F.percentile_approx(ts_col, quantile, int(round(1.0 / relative_error))).cast("bigint").alias("split_ts"))
    counts = df.groupBy(F.col(ts_col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, "v", ["n"], rows_per_range=rows_per_range)
    return cum.where(F.col("cum_n") >= F.lit(quantile) * F.col("total_n")).agg(F.min("v").cast("bigint").alias("split_ts"))


def split_by_time(df: DataFrame, quantile: float = 0.8, relative_error: float = 0.05, ts_col: str = "ts") -> tuple[DataFrame, DataFrame, int]:
    """Rows at or before the ``quantile`` time go to train, later rows to test.

    The split point is one scalar (fetched like ``approxQuantile`` does); as a
    literal it lets the two filters reach the parquet scan.
    """
    split_ts = _split_ts(df, quantile, relative_error, ts_col)
    return df.where(F.col(ts_col) <= split_ts), df.where(F.col(ts_col) > split_ts), split_ts


def _split_ts(df: DataFrame, quantile: float, relative_error: float, ts_col: str) -> int:
    if relative_error > 0:
        return time_split_point(df, quantile, relative_error, ts_col).first()["split_ts"]
    return time_split_point(df, quantile, 0.0, ts_col).first()["split_ts"]


def split_and_save(samples: DataFrame, path: str, fraction: float = 0.1, seed: int = 42, by: str = "random",
                   train_fraction: float = 0.8, quantile: float = 0.8, relative_error: float = 0.05,
                   files: int | None = None) -> tuple[str, str]:
    """X4 (and its time-based twin): sample, split, write train and test as headered CSV.

    ``by="random"``: hash-uniform ``train_fraction`` split; ``by="time"``:
    rows at or before the ``quantile`` timestamp of the sample go to train.
    Returns the two paths written (``path/train``, ``path/test``).
    """
    from reelsift.sinks.files import write_samples

    small = sample_rows(samples, fraction, seed)
    if by == "random":
        train, test = random_split(small, train_fraction, seed)
    elif by == "time":
        train, test, _ = split_by_time(small, quantile, relative_error)
    else:
        raise ValueError(f"by must be 'random' or 'time', not {by!r}")
    return write_samples(train, f"{path}/train", files), write_samples(test, f"{path}/test", files)
