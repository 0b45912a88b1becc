"""Shared pieces of the catalog: canonical frames and SQL fragments for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.operators.samples import add_label
from reelsift.session import written
from reelsift.sources import canonical as cv


def views(spark: SparkSession, sf_dir: str):
    return cv.ratings(spark, sf_dir), cv.items(spark, sf_dir)


def kept_views(spark: SparkSession, sf_dir: str):
    """``views`` for queries that use the ratings more than once: derived from lineitem and orders once, written to the
    shared checkpoint folder and read from there."""
    return written(cv.ratings(spark, sf_dir)), cv.items(spark, sf_dir)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_label(cv.ratings(spark, sf_dir))


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---- DuckDB fragments -------------------------------------------------------

def sql_fmt2(x: str) -> str:
    return f"format('{{:,.2f}}', round({x}, 6))"


def sql_year(t: str, default: str = "1990", unparsed: str = "NULL") -> str:
    tt = f"trim({t})"
    slice_ = f"TRY_CAST(substr({tt}, length({tt}) - 4, 4) AS INTEGER)"
    parsed = slice_ if unparsed == "NULL" else f"coalesce({slice_}, {unparsed})"
    return f"CAST(CASE WHEN {t} IS NULL OR length({tt}) < 6 THEN {default} ELSE {parsed} END AS BIGINT)"


def sql_genre_list(g: str) -> str:
    s = f"regexp_replace({g}, '[|]+$', '')"
    return f"(CASE WHEN {g} IS NULL OR trim({g}) = '' OR {s} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({s}, '|') END)"


def sql_uniform(parts: list[str], seed: int) -> str:
    key = "concat_ws(':', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + f", '{seed}')"
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


LABELLED_SQL = "labelled AS (SELECT user_id, item_id, rating, ts, CAST(CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS BIGINT) AS label FROM ratings)"

ITEM_FEATURES_SQL = f"""
item_stats AS (
  SELECT item_id, count(*) AS movie_rating_count,
         {sql_fmt2('avg(rating)')} AS movie_avg_rating,
         {sql_fmt2('coalesce(stddev_samp(rating), 0)')} AS movie_rating_stddev
  FROM ratings GROUP BY item_id),
item_feats AS (
  SELECT l.user_id, l.item_id, l.rating, l.ts, l.label,
         {sql_year('i.title')} AS release_year, i.genres,
         string_split(i.genres, '|')[1] AS movie_genre1,
         string_split(i.genres, '|')[2] AS movie_genre2,
         string_split(i.genres, '|')[3] AS movie_genre3,
         s.movie_rating_count, s.movie_avg_rating, s.movie_rating_stddev
  FROM labelled l LEFT JOIN items i ON l.item_id = i.item_id LEFT JOIN item_stats s ON l.item_id = s.item_id)"""


def user_features_sql(history: int, source: str = "item_feats", keep_first: bool = False) -> str:
    """CTE ``user_feats`` over ``source`` (needs label, release_year, genres)."""
    w = f"(PARTITION BY user_id ORDER BY ts, item_id ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)"
    hist = f"coalesce(list(item_id) FILTER (WHERE label = 1) OVER {w}, [])"
    ghist = f"coalesce(list(genres) FILTER (WHERE label = 1 AND genres IS NOT NULL) OVER {w}, [])"
    where = "" if keep_first else "WHERE user_rating_count > 1"
    slots = ",\n         ".join(f"list_reverse(_hist)[{i}] AS user_rated_movie{i}" for i in range(1, 6))
    gslots = ",\n         ".join(f"_genres[{i}] AS user_genre{i}" for i in range(1, 6))
    return f"""
uf_win AS (
  SELECT *,
         {hist} AS _hist,
         count(*) OVER {w} AS user_rating_count,
         trunc(avg(release_year) OVER {w}) AS _avg_year,
         stddev_samp(release_year) OVER {w} AS _year_sd,
         avg(rating) OVER {w} AS _avg_rating,
         stddev_samp(rating) OVER {w} AS _rating_sd,
         {ghist} AS _ghist
  FROM {source}),
uf_genres AS (
  SELECT *, list_transform(
           list_sort(list_transform(list_distinct(_all),
             lambda g: {{'k': -len(list_filter(_all, lambda x: x = g)), 'genre': g}})),
           lambda s: s.genre) AS _genres
  FROM (SELECT *, flatten(list_transform(_ghist, lambda s: string_split(s, '|'))) AS _all FROM uf_win) z),
user_feats AS (
  SELECT user_id, item_id, rating, ts, label, release_year,
         movie_genre1, movie_genre2, movie_genre3, movie_rating_count, movie_avg_rating, movie_rating_stddev,
         {slots},
         user_rating_count,
         CAST(coalesce(_avg_year, 0) AS BIGINT) AS user_avg_release_year,
         {sql_fmt2('coalesce(_year_sd, 0)')} AS user_release_year_stddev,
         {sql_fmt2('_avg_rating')} AS user_avg_rating,
         {sql_fmt2('coalesce(_rating_sd, 0)')} AS user_rating_stddev,
         {gslots}
  FROM uf_genres {where})"""


def sql_genre_pieces(g: str) -> str:
    """As ``genre_pieces``: a blank string is one blank genre."""
    return f"(CASE WHEN {g} = '' THEN [''] ELSE {sql_genre_list(g)} END)"


#: Every 89th item gets a blank genre string: the rule for blanks shows in the checked queries.
BLANK_GENRES_MOD = 89
BLANKED_ITEMS_SQL = f"SELECT item_id, CASE WHEN item_id % {BLANK_GENRES_MOD} = 0 THEN '' ELSE genres END AS genres FROM items"


def blanked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.col("item_id") % BLANK_GENRES_MOD == 0
    return cv.items(spark, sf_dir).withColumn("genres", F.when(blank, "").otherwise(F.col("genres")))
