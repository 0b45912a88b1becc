"""User-side features: point-in-time windows, profiles, last item.

All user features share one frame: the ``history`` rows of the same user
*before* the current one by (ts, item_id).  One shuffle and one sort bring a
user's rows together; ``sliding`` then keeps running totals from which the
total ``history`` rows earlier is taken away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions import fmt2, genre_array
from reelsift.operators.item_features import latest_per_key
from reelsift.operators.positions import BLOCK_ROWS, HEAVY_ROWS, blocks, heavy_keys, heavy_positions, split_heavy
from reelsift.operators.sliding import add_frames

USER_HISTORY = 100  # fixed value: rows before the current one
SLOTS = 5  # fixed value: recent items and preferred genres kept as columns


def preferred_genres(genre_strings: Column, pre_split: bool = False) -> Column:
    """Genres of a list of ``A|B|C`` strings (or, with ``pre_split``, of
    genre arrays), by frequency desc then name.

    Higher-order functions over the bounded history list: flatten the pieces,
    sort them once, count runs in one ``aggregate`` pass, then sort the
    (-count, genre) runs.  O(n log n) per row with no per-genre rescans.
    """
    pieces = genre_strings if pre_split else F.transform(genre_strings, lambda g: F.split(g, "[|]"))
    every = F.array_sort(F.flatten(pieces))
    run_type = "array<struct<k:int,genre:string>>"

    def close(acc):
        done = F.array_append(acc["runs"], F.struct((-acc["n"]).alias("k"), acc["cur"].alias("genre")))
        return F.when(acc["n"] == 0, acc["runs"]).otherwise(done)

    def step(acc, x):
        same = (acc["n"] > 0) & (acc["cur"] == x)
        return F.when(same, F.struct(acc["runs"].alias("runs"), acc["cur"].alias("cur"), (acc["n"] + 1).alias("n"))).otherwise(
            F.struct(close(acc).alias("runs"), x.alias("cur"), F.lit(1).alias("n"))
        )

    init = F.struct(F.array().cast(run_type).alias("runs"), F.lit(None).cast("string").alias("cur"), F.lit(0).alias("n"))
    runs = F.aggregate(every, init, step, close)
    return F.transform(F.array_sort(runs), lambda r: r["genre"])


def _frame_features(samples: DataFrame, keys: list[str], order: list[str], history: int, base: list[str], numeric: bool = False, lists: bool = False) -> DataFrame:
    feats = add_frames(samples, keys, order, base, history, None if lists else SLOTS)
    zero = F.lit(0.0)
    year_sd, rating_sd = F.coalesce("_year_sd", zero), F.coalesce("_rating_sd", zero)
    twins = [
        F.col("_avg_rating").alias("user_avg_rating_num"),
        rating_sd.alias("user_rating_stddev_num"),
        year_sd.alias("user_release_year_stddev_num"),
    ] if numeric else []
    whole = [F.col("_hist").alias("positive_history"), F.col("_genres").alias("preferred_genres")] if lists else []
    return feats.select(
        *base,
        *[F.get("_hist", i).alias(f"user_rated_movie{i + 1}") for i in range(SLOTS)],
        "user_rating_count",
        F.coalesce(F.col("_avg_year").cast("int"), F.lit(0)).alias("user_avg_release_year"),
        fmt2(year_sd).alias("user_release_year_stddev"),
        fmt2("_avg_rating").alias("user_avg_rating"),
        fmt2(rating_sd).alias("user_rating_stddev"),
        *[F.get("_genres", i).alias(f"user_genre{i + 1}") for i in range(SLOTS)],
        *twins,
        *whole,
    )


def add_user_features(
    samples: DataFrame,
    history: int = USER_HISTORY,
    keep_first: bool = False,
    heavy_rows: int | None = HEAVY_ROWS,
    block_rows: int = BLOCK_ROWS,
    heavy: list[tuple] | None = None,
    numeric: bool = False,
    lists: bool = False,
) -> DataFrame:
    """Point-in-time user features for each labelled sample.

    The averages and deviations are two-decimal text, as the reference
    stores them; ``numeric=True`` adds ``*_num`` double twins for models, and
    ``lists=True`` the whole lists that the five slots are cut from:
    ``positive_history`` (newest first) and ``preferred_genres``.

    ``samples`` needs user_id, item_id, ts, rating, label, release_year, genres.
    Numeric nulls become 0 (P11) before formatting (P13); samples with at most
    one prior rating are dropped (P3) unless ``keep_first``.

    Users with more than ``heavy_rows`` samples (``heavy``: precomputed
    (user_id, rows) list, else detected here) take the blocked path of
    ``positions``: the same frames over (user, block) with ``history`` rows
    of copied context, so no task holds a whole heavy user.
    """
    base = [c for c in samples.columns if c != "genres"]
    if heavy is None:
        heavy = heavy_keys(samples, "user_id", heavy_rows) if heavy_rows else []
    if not heavy:
        out = _frame_features(samples, ["user_id"], ["ts", "item_id"], history, base, numeric, lists)
    else:
        light, hot_rows, _ = split_heavy(samples, "user_id", heavy)
        plain = _frame_features(light, ["user_id"], ["ts", "item_id"], history, base, numeric, lists)
        positioned = heavy_positions(hot_rows, "user_id", ["ts", "item_id"], sum(n for _, n in heavy), block_rows)
        blocked = blocks(positioned, block_rows, history)
        hot = _frame_features(blocked, ["user_id", "_block"], ["pos"], history, base + ["_ctx"], numeric, lists).where(~F.col("_ctx")).drop("_ctx")
        out = plain.unionByName(hot)
    return out if keep_first else out.where(F.col("user_rating_count") > 1)


USER_FEATURE_COLUMNS = (
    [f"user_rated_movie{i + 1}" for i in range(SLOTS)]
    + ["user_rating_count", "user_avg_release_year", "user_release_year_stddev", "user_avg_rating", "user_rating_stddev"]
    + [f"user_genre{i + 1}" for i in range(SLOTS)]
)


def latest_user_features(samples: DataFrame) -> DataFrame:
    """The user feature block of each user's latest sample (ties: larger item_id)."""
    latest = latest_per_key(samples, "user_id", ["ts", "item_id"], USER_FEATURE_COLUMNS)
    return latest


def user_profile(ratings: DataFrame) -> DataFrame:
    """Average, highest (never below 0), lowest (never above 5.0) and count per user."""
    return ratings.groupBy("user_id").agg(
        F.avg("rating").alias("average_rating"),
        F.greatest(F.lit(0.0), F.max("rating")).alias("highest_rating"),
        F.least(F.lit(5.0), F.min("rating")).alias("lowest_rating"),
        F.count(F.lit(1)).alias("rating_count"),
    )


def last_item(ratings: DataFrame) -> DataFrame:
    """Each user's last rated item by (ts, item_id) -- the serving side's history."""
    return ratings.groupBy("user_id").agg(F.max(F.struct("ts", "item_id"))["item_id"].alias("item_id"))


def user_history_genres(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct genres of each user's history item(s)."""
    hist = last_item(ratings)
    g = items.select("item_id", F.explode(genre_array("genres")).alias("genre"))
    return hist.join(g, "item_id").select("user_id", "genre").distinct()
