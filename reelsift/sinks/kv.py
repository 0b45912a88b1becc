"""Key-value sinks (K4-K8): feature-store entries in the generations of ``sources.kv_store``.

A row is ``(prefix, key, value, features, expires_at)``: vector entries fill
``value`` (``v1 v2 ...``), feature entries fill ``features`` (a string map).
``expires_at = as_of + ttl`` replaces the store's TTL; readers drop expired
rows and compaction removes them.  ``foreach_entry`` hands each partition to a
user's own client for a real store, without collecting to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.sources import kv_store

DAY_SECONDS = 24 * 60 * 60
DEFAULT_TTL = DAY_SECONDS  # fixed value: 24 h expiry of the embedding entries
ITEM_EMB_PREFIX = "i2vEmb"
USER_EMB_PREFIX = "uEmb"
ITEM_FEATURE_PREFIX = "mf"
USER_FEATURE_PREFIX = "uf"

ITEM_FEATURE_FIELDS = [  # fixed value: field names of the item feature entry
    ("movieGenre1", "movie_genre1"),
    ("movieGenre2", "movie_genre2"),
    ("movieGenre3", "movie_genre3"),
    ("movieRatingCount", "movie_rating_count"),
    ("releaseYear", "release_year"),
    ("movieAvgRating", "movie_avg_rating"),
    ("movieRatingStddev", "movie_rating_stddev"),
]
USER_FEATURE_FIELDS = [  # fixed value: field names of the user feature entry
    ("userRatedMovie1", "user_rated_movie1"),
    ("userRatedMovie2", "user_rated_movie2"),
    ("userRatedMovie3", "user_rated_movie3"),
    ("userRatedMovie4", "user_rated_movie4"),
    ("userRatedMovie5", "user_rated_movie5"),
    ("userGenre1", "user_genre1"),
    ("userGenre2", "user_genre2"),
    ("userGenre3", "user_genre3"),
    ("userGenre4", "user_genre4"),
    ("userGenre5", "user_genre5"),
    ("userRatingCount", "user_rating_count"),
    ("userAvgReleaseYear", "user_avg_release_year"),
    ("userReleaseYearStddev", "user_release_year_stddev"),
    ("userAvgRating", "user_avg_rating"),
    ("userRatingStddev", "user_rating_stddev"),
]


def _expiry(as_of: int | None, ttl: int | None):
    if as_of is None or ttl is None:
        return F.lit(None).cast("bigint")
    return F.lit(int(as_of) + int(ttl)).cast("bigint")


def to_kv_embeddings(df: DataFrame, prefix: str, id_col: str = "item_id", emb: str = "emb",
                     as_of: int | None = None, ttl: int | None = DEFAULT_TTL) -> DataFrame:
    """K4/K5: ``<prefix>:<id>`` -> ``v1 v2 ... vn``."""
    vals = F.array_join(F.transform(F.col(emb), lambda x: x.cast("float").cast("string")), " ")
    return df.select(
        F.lit(prefix).alias("prefix"),
        F.concat(F.lit(prefix + ":"), F.col(id_col).cast("string")).alias("key"),
        vals.alias("value"),
        F.lit(None).cast("map<string,string>").alias("features"),
        _expiry(as_of, ttl).alias("expires_at"),
    )


def _feature_kv(df: DataFrame, prefix: str, id_col: str, fields, as_of, ttl) -> DataFrame:
    kv = []
    for name, col in fields:
        kv += [F.lit(name), F.coalesce(F.col(col).cast("string"), F.lit(""))]
    return df.select(
        F.lit(prefix).alias("prefix"),
        F.concat(F.lit(prefix + ":"), F.col(id_col).cast("string")).alias("key"),
        F.lit(None).cast("string").alias("value"),
        F.create_map(*kv).alias("features"),
        _expiry(as_of, ttl).alias("expires_at"),
    )


def item_feature_kv(latest_items: DataFrame, as_of: int | None = None, ttl: int | None = None) -> DataFrame:
    """K6: ``mf:<item>`` -> 7-field string map (nulls as "")."""
    return _feature_kv(latest_items, ITEM_FEATURE_PREFIX, "item_id", ITEM_FEATURE_FIELDS, as_of, ttl)


def user_feature_kv(latest_users: DataFrame, as_of: int | None = None, ttl: int | None = None) -> DataFrame:
    """K7: ``uf:<user>`` -> 15-field string map (nulls as "")."""
    return _feature_kv(latest_users, USER_FEATURE_PREFIX, "user_id", USER_FEATURE_FIELDS, as_of, ttl)


def write_kv(kv: DataFrame, path: str, mode: str = "append", version: int | None = None, buckets: int = kv_store.BUCKETS, compact_after: int = kv_store.COMPACT_AFTER) -> str:
    """Write entries as a new generation of the store (K4-K8); ``overwrite`` replaces the whole store.

    An entry replaces an earlier one of its key, as a store's ``set`` does.  Generations are numbered by the store, not
    by a clock; a ``version`` of the caller's must be larger than any before it, and two writes of one version are an
    error.  After ``compact_after`` generations the store is compacted.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    kv_store.add(kv, path, version, whole=mode == "overwrite", n_buckets=buckets)
    if len(kv_store.live(kv.sparkSession, path)) > compact_after:
        kv_store.compact(kv.sparkSession, path)
    return path


def foreach_entry(kv: DataFrame, put: Callable) -> None:
    """Push entries to an external store, one partition at a time on the executors."""

    def part(rows):
        for r in rows:
            put(r["key"], r["value"], r["features"], r["expires_at"])

    kv.foreachPartition(part)
