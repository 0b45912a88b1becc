"""Key-value snapshot sources.

The key-value store is a folder of generations (``kv_store``), each partitioned
by prefix and key bucket; readers see the newest entry of a key, read only the
prefix (and the buckets of the keys) asked for, and drop entries expired at
their ``as_of`` time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.sources import kv_store
from reelsift.sources.files import parse_vector, read_embeddings


def read_kv(spark: SparkSession, path: str, prefix: str, as_of: int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Entries of a prefix (of the given whole keys only): the newest write of each key, without those expired at ``as_of``."""
    kv = kv_store.newest(spark, path, prefix, keys).drop("version", "bucket")
    if as_of is not None:
        kv = kv.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(as_of)))
    return kv.select("prefix", "key", "value", "features", "expires_at")


def read_kv_embeddings(spark: SparkSession, path: str, prefix: str, id_col: str = "item_id", as_of: int | None = None) -> DataFrame:
    """Entries ``<prefix>:<id>`` -> vector text, parsed like the file source."""
    kv = read_kv(spark, path, prefix, as_of)
    return kv.select(
        F.get(F.split("key", ":"), 1).try_cast("bigint").alias(id_col), parse_vector(F.col("value")).alias("emb")
    ).where(F.col(id_col).isNotNull() & F.col("emb").isNotNull())


def read_kv_features(spark: SparkSession, path: str, prefix: str, id_col: str = "item_id", as_of: int | None = None) -> DataFrame:
    """Entries ``<prefix>:<id>`` -> feature map."""
    kv = read_kv(spark, path, prefix, as_of)
    return kv.select(F.get(F.split("key", ":"), 1).try_cast("bigint").alias(id_col), "features").where(F.col(id_col).isNotNull())


def join_features(ids: DataFrame, features: DataFrame, id_col: str = "item_id") -> DataFrame:
    """``ids`` with the feature map of each id (null: none).  Both sides are shuffled: maps take many times the bytes of
    their Parquet files, from which Spark would take a large store for one to broadcast through the driver."""
    return ids.join(features.hint("shuffle_merge"), id_col, "left")


def load_embeddings(spark: SparkSession, source: str, path: str, prefix: str | None = None, id_col: str = "item_id",
                    as_of: int | None = None) -> DataFrame:
    """One entry point for both embedding sources (``file`` or ``kv``)."""
    if source == "file":
        return read_embeddings(spark, path, id_col)
    if source == "kv":
        return read_kv_embeddings(spark, path, prefix, id_col, as_of)
    raise ValueError(f"unknown embedding source {source!r}")


def load_features(spark: SparkSession, enabled: bool, path: str, prefix: str, id_col: str = "item_id", as_of: int | None = None) -> DataFrame:
    """The optional feature load: the prefix's feature maps when ``enabled``, else no rows (of the same columns)."""
    if enabled:
        return read_kv_features(spark, path, prefix, id_col, as_of)
    return spark.createDataFrame([], f"{id_col} bigint, features map<string,string>")
