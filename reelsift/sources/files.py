"""File sources (S1-S8): headered CSV, strict field-count loaders, embedding text.

Strict loaders mirror the serving side's line parser: a line is split on ','
(trailing empty pieces dropped), kept only with exactly the expected number of
fields, and typed with ``try_cast``; a line that does not parse (the header
among them) is skipped instead of failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions import clean_title, genre_array, release_year

RATINGS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ("userId", "movieId", "rating", "timestamp")])
ITEMS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ("movieId", "title", "genres")])
LINKS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ("movieId", "imdbId", "tmdbId")])


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered ratings CSV, all strings at read, typed once with try_cast."""
    raw = spark.read.csv(path, header=True, schema=RATINGS_CSV, mode="PERMISSIVE")
    return raw.select(
        F.col("userId").try_cast("bigint").alias("user_id"),
        F.col("movieId").try_cast("bigint").alias("item_id"),
        F.col("rating").try_cast("double").alias("rating"),
        F.col("timestamp").try_cast("bigint").alias("ts"),
    )


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered items CSV; quoted titles with commas are honoured."""
    raw = spark.read.csv(path, header=True, schema=ITEMS_CSV, mode="PERMISSIVE", quote='"', escape='"')
    return raw.select(F.col("movieId").try_cast("bigint").alias("item_id"), "title", "genres")


def _fields(value: Column) -> Column:
    """Java-style ``line.split(",")``: trailing empty pieces are dropped."""
    return F.split(F.regexp_replace(value, ",+$", ""), ",")


def _strict(spark: SparkSession, path: str, n: int) -> DataFrame:
    lines = spark.read.text(path)
    f = _fields(F.col("value"))
    return lines.select(f.alias("f")).where(F.size("f") == n)


def load_items_strict(spark: SparkSession, path: str) -> DataFrame:
    """S3: exactly 3 fields; year and clean title parsed (year 0 when absent),
    genre list (blank -> empty).  Titles with commas do not survive (the rule)."""
    rows = _strict(spark, path, 3).select(
        F.get("f", 0).try_cast("bigint").alias("item_id"),
        F.trim(F.get("f", 1)).alias("raw_title"),
        F.get("f", 2).alias("genres"),
    ).where(F.col("item_id").isNotNull())
    return rows.select(
        "item_id",
        clean_title("raw_title").alias("title"),
        release_year("raw_title", default=0, unparsed=0).alias("release_year"),
        genre_array("genres").alias("genre_list"),
        "genres",
    )


def load_ratings_strict(spark: SparkSession, path: str) -> DataFrame:
    """Exactly 4 fields typed int / int / float / long; other lines skipped."""
    rows = _strict(spark, path, 4).select(
        F.get("f", 0).try_cast("int").cast("bigint").alias("user_id"),
        F.get("f", 1).try_cast("int").cast("bigint").alias("item_id"),
        F.get("f", 2).try_cast("float").alias("rating"),
        F.get("f", 3).try_cast("bigint").alias("ts"),
    )
    return rows.dropna(how="any")


def load_links(spark: SparkSession, path: str) -> DataFrame:
    """Exactly 3 fields; ids kept as trimmed strings."""
    rows = _strict(spark, path, 3).select(
        F.get("f", 0).try_cast("bigint").alias("item_id"),
        F.trim(F.get("f", 1)).alias("imdb_id"),
        F.trim(F.get("f", 2)).alias("tmdb_id"),
    )
    return rows.where(F.col("item_id").isNotNull())


def parse_vector(text: Column) -> Column:
    """``v1 v2 ... vn`` -> ARRAY<FLOAT>, split on single whitespace characters
    (trailing empty pieces dropped); null when any piece is not a number."""
    pieces = F.split(F.regexp_replace(text, "\\s+$", ""), "\\s")
    vals = F.transform(pieces, lambda x: x.try_cast("float"))
    return F.when(F.exists(vals, lambda v: v.isNull()), F.lit(None).cast("array<float>")).otherwise(vals)


def read_embeddings(spark: SparkSession, path: str, id_col: str = "item_id") -> DataFrame:
    """Text lines ``id:v1 v2 ...`` with exactly one ':'; unparseable lines skipped."""
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), ":")
    rows = lines.select(parts.alias("p")).where(F.size("p") == 2).select(
        F.get("p", 0).try_cast("bigint").alias(id_col), parse_vector(F.get("p", 1)).alias("emb")
    )
    return rows.where(F.col(id_col).isNotNull() & F.col("emb").isNotNull())


def read_embeddings_multi(spark: SparkSession, paths: list[str], id_col: str = "item_id") -> DataFrame:
    """Several embedding files; for an id in more than one, the later file wins.

    An aggregate (max of (file position, vector)) rather than a window, so it
    combines map-side.
    """
    frames = [read_embeddings(spark, p, id_col).withColumn("_prec", F.lit(i)) for i, p in enumerate(paths)]
    allv = reduce(lambda a, b: a.unionByName(b), frames)
    return allv.groupBy(id_col).agg(F.max(F.struct("_prec", "emb"))["emb"].alias("emb"))
