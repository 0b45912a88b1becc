"""Item-side features: rating statistics, profiles, top ratings, the per-sample
item feature block and the latest item feature row (A2-A5, J1-J2, P4, P7, W9, W10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.functions import fmt2, genre_slot, release_year

TOP_RATINGS_PER_ITEM = 10  # fixed value: ratings kept per item


def item_stats(ratings: DataFrame, numeric: bool = False) -> DataFrame:
    """A2: per item count, average and sample stddev (one rating -> 0), as two-decimal text
    (``numeric=True`` adds ``*_num`` double twins).

    Aggregated straight from the ratings (no item columns needed), so the
    aggregation combines map-side before the shuffle on item_id.
    """
    g = ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("movie_rating_count"),
        F.avg("rating").alias("avg"),
        F.stddev_samp("rating").alias("sd"),
    )
    sd = F.coalesce(F.nanvl("sd", F.lit(0.0)), F.lit(0.0))
    twins = [F.col("avg").alias("movie_avg_rating_num"), sd.alias("movie_rating_stddev_num")] if numeric else []
    return g.select(
        "item_id",
        "movie_rating_count",
        fmt2("avg").alias("movie_avg_rating"),
        fmt2(sd).alias("movie_rating_stddev"),
        *twins,
    )


def item_rating_variance(ratings: DataFrame) -> DataFrame:
    """A3: per item count, average and sample variance (null for one rating)."""
    return ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg("rating").alias("avg_rating"),
        F.var_samp("rating").alias("rating_var"),
    )


def item_profile(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """A4 (+P5, P6, P8): the item object of the serving side as a row.

    Ratings of unknown items are ignored; unrated items get count 0 and
    average 0.  ``release_year`` uses the strict rule (0 when it does not
    parse), ``genre_list`` keeps the loader's blank -> empty rule.
    """
    from reelsift.functions import clean_title, genre_array

    stats = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("a"))
    return items.join(stats, "item_id", "left").select(
        "item_id",
        clean_title("title").alias("title"),
        release_year("title", default=0, unparsed=0).alias("release_year"),
        genre_array("genres").alias("genre_list"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("rating_number"),
        F.coalesce("a", F.lit(0.0)).alias("average_rating"),
    )


def top_ratings(ratings: DataFrame, items: DataFrame, n: int = TOP_RATINGS_PER_ITEM) -> DataFrame:
    """A5: the n best ratings of each known item; an earlier rating wins ties.

    ``top_rank`` 1 is the best.  Earlier = smaller (ts, user_id).  The window
    is a rank limit, which Spark plans as a WindowGroupLimit below the
    shuffle, so each map task ships at most n rows per item.
    """
    known = ratings.join(items.select("item_id"), "item_id", "left_semi")
    w = Window.partitionBy("item_id").orderBy(F.col("rating").desc(), F.col("ts").asc(), F.col("user_id").asc())
    return known.withColumn("top_rank", F.row_number().over(w)).where(F.col("top_rank") <= n)


def add_item_features(samples: DataFrame, items: DataFrame, numeric: bool = False) -> DataFrame:
    """W9 (J1, P4, P7, A2, J2): append item columns and item statistics to rating samples.

    Items and the per-item statistics meet first, one row an item (every sample's
    item has statistics), so the samples are joined once.  Titles take many times the bytes of their Parquet files:
    they are shuffled, never broadcast by the files' size.
    """
    stats = item_stats(samples.select("item_id", "rating"), numeric)
    per_item = stats.join(items.select("item_id", "title", "genres").hint("shuffle_merge"), "item_id", "left")
    twins = ["movie_avg_rating_num", "movie_rating_stddev_num"] if numeric else []
    return samples.join(per_item, "item_id", "left").select(
        *[c for c in samples.columns],
        release_year("title").alias("release_year"),
        "genres",
        genre_slot("genres", 0).alias("movie_genre1"),
        genre_slot("genres", 1).alias("movie_genre2"),
        genre_slot("genres", 2).alias("movie_genre3"),
        "movie_rating_count",
        "movie_avg_rating",
        "movie_rating_stddev",
        *twins,
    )


ITEM_FEATURE_COLUMNS = [
    "release_year",
    "movie_genre1",
    "movie_genre2",
    "movie_genre3",
    "movie_rating_count",
    "movie_avg_rating",
    "movie_rating_stddev",
]


def latest_per_key(df: DataFrame, key: str, order_cols: list[str], keep: list[str]) -> DataFrame:
    """The row with the largest ``order_cols`` per ``key``, as an aggregate.

    ``max(struct(order..., payload...))`` combines map-side, so a hot key costs
    one row per map task in the shuffle, which ``row_number() = 1`` would not.
    (Spark plans it as a sort aggregate: struct buffers are not hashed.)
    """
    packed = F.max(F.struct(*[F.col(c) for c in order_cols], *[F.col(c).alias(f"__{c}") for c in keep])).alias("m")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"m.__{c}").alias(c) for c in keep])


def latest_item_features(samples: DataFrame) -> DataFrame:
    """The item feature block of each item's latest sample (ties: larger user_id).

    Null strings become "" as in the feature store export.
    """
    latest = latest_per_key(samples, "item_id", ["ts", "user_id"], ITEM_FEATURE_COLUMNS)
    return latest.na.fill("")
