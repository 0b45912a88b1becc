"""User profiles kept up to date (A6, A12): a mergeable state a user, to which new ratings are added without reading the
history again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_state(ratings: DataFrame) -> DataFrame:
    """One row a user: count, sum, highest and lowest of the ratings, and the latest (ts, item_id)."""
    return ratings.groupBy("user_id").agg(
        F.count("rating").alias("n"),
        F.sum(F.col("rating").cast("double")).alias("total"),
        F.max("rating").alias("high"),
        F.min("rating").alias("low"),
        F.max(F.struct("ts", "item_id")).alias("last"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all ratings behind the given states, which must not share a rating.  Merging is associative and
    combines map-side; its cost follows the users of the states, not their histories."""
    return reduce(DataFrame.unionByName, states).groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("last").alias("last")
    )


def profile_of(state: DataFrame) -> DataFrame:
    """A6 and A12 from a state: average, highest (never below 0), lowest (never above 5.0), count and last item."""
    return state.select(
        "user_id",
        F.try_divide("total", "n").alias("average_rating"),
        F.greatest(F.lit(0.0), "high").alias("highest_rating"),
        F.least(F.lit(5.0), "low").alias("lowest_rating"),
        F.col("n").alias("rating_count"),
        F.col("last.item_id").alias("item_id"),
    )
