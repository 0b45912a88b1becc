"""Explicit schemas of the canonical tables (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),  # epoch seconds
])
ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),  # "Name (YYYY)"
    T.StructField("genres", T.StringType()),  # "A|B|C"
])
LINKS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("tmdb_id", T.StringType()),
])
ITEM_EMB = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("emb", T.ArrayType(T.FloatType()))])
USER_EMB = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("emb", T.ArrayType(T.DoubleType()))])
KV = T.StructType([
    T.StructField("prefix", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("features", T.MapType(T.StringType(), T.StringType())),
    T.StructField("expires_at", T.LongType()),
])

TABLES = {"ratings": RATINGS, "items": ITEMS, "links": LINKS, "item_emb": ITEM_EMB, "user_emb": USER_EMB}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a stored canonical table (parquet) with its explicit schema."""
    return spark.read.schema(TABLES[name]).parquet(path)


def conforms(df: DataFrame, name: str) -> bool:
    """True when ``df`` has the canonical table's column names and types (nullability ignored)."""
    want = [(f.name, f.dataType) for f in TABLES[name].fields]
    return [(f.name, f.dataType) for f in df.schema.fields] == want
