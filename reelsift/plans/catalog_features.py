"""Catalog: labels, aggregates, item and user features, training samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsift.functions import genre_pieces
from reelsift.operators import item_features as itf
from reelsift.operators import profiles
from reelsift.operators import samples as smp
from reelsift.operators import user_features as uf
from reelsift.plans.common import (
    BLANKED_ITEMS_SQL,
    ITEM_FEATURES_SQL,
    LABELLED_SQL,
    blanked_items,
    kept_views,
    labelled,
    sql_genre_list,
    sql_genre_pieces,
    sql_year,
    user_features_sql,
    views,
)
from reelsift.plans.registry import query
from reelsift.session import written
from reelsift.sources import canonical as cv


@query("label_samples", "SELECT user_id, item_id, rating, ts, label FROM labelled", LABELLED_SQL)
def label_samples(spark, d):
    return labelled(spark, d)


@query("filter_positive", "SELECT user_id, item_id, rating, ts FROM ratings WHERE rating >= 3.5")
def filter_positive(spark, d):
    return smp.filter_positive(cv.ratings(spark, d))


@query(
    "rating_distribution",
    """SELECT rating, count(*) AS rating_count,
              round(count(*) / sum(count(*)) OVER (), 6) AS percentage
       FROM ratings GROUP BY rating""",
)
def rating_distribution(spark, d):
    return smp.rating_distribution(cv.ratings(spark, d))


@query(
    "item_rating_stats",
    "SELECT item_id, movie_rating_count, movie_avg_rating, movie_rating_stddev FROM item_stats",
    ITEM_FEATURES_SQL.split("item_feats AS")[0].rstrip().rstrip(","),
)
def item_rating_stats(spark, d):
    return itf.item_stats(cv.ratings(spark, d))


@query(
    "item_rating_variance",
    """SELECT item_id, count(*) AS rating_count, round(avg(rating), 6) AS avg_rating,
              round(var_samp(rating), 6) AS rating_var
       FROM ratings GROUP BY item_id""",
)
def item_rating_variance(spark, d):
    return itf.item_rating_variance(cv.ratings(spark, d))


_TITLE = "trim(i.title)"
_HAS_YEAR = f"(length({_TITLE}) >= 6 AND TRY_CAST(substr({_TITLE}, length({_TITLE}) - 4, 4) AS INTEGER) IS NOT NULL)"


@query(
    "item_profile",
    f"""SELECT i.item_id,
              CASE WHEN {_HAS_YEAR} THEN trim(substr({_TITLE}, 1, length({_TITLE}) - 6)) ELSE {_TITLE} END AS title,
              {sql_year('i.title', '0', '0')} AS release_year,
              len({sql_genre_list('i.genres')}) AS genre_count,
              array_to_string({sql_genre_list('i.genres')}, '|') AS genre_text,
              coalesce(s.n, 0) AS rating_number,
              round(coalesce(s.a, 0), 6) AS average_rating
       FROM items i LEFT JOIN (SELECT item_id, count(*) AS n, avg(rating) AS a FROM ratings GROUP BY item_id) s
         ON i.item_id = s.item_id""",
)
def item_profile(spark, d):
    r, i = views(spark, d)
    p = itf.item_profile(i, r)
    return p.select(
        "item_id", "title", "release_year",
        F.size("genre_list").alias("genre_count"), F.array_join("genre_list", "|").alias("genre_text"),
        "rating_number", "average_rating",
    )


@query(
    "item_top_ratings",
    """SELECT item_id, user_id, rating, ts, top_rank FROM (
         SELECT r.*, row_number() OVER (PARTITION BY r.item_id ORDER BY rating DESC, ts, user_id) AS top_rank
         FROM ratings r SEMI JOIN items i ON r.item_id = i.item_id) x
       WHERE top_rank <= 10""",
)
def item_top_ratings(spark, d):
    r, i = views(spark, d)
    return itf.top_ratings(r, i).select("item_id", "user_id", "rating", "ts", "top_rank")


@query(
    "user_profile",
    """SELECT user_id, round(avg(rating), 6) AS average_rating, greatest(0.0, max(rating)) AS highest_rating,
              least(5.0, min(rating)) AS lowest_rating, count(*) AS rating_count
       FROM ratings GROUP BY user_id""",
)
def user_profile(spark, d):
    return uf.user_profile(cv.ratings(spark, d))


@query("user_last_item", "SELECT user_id, arg_max(item_id, (ts, item_id)) AS item_id FROM ratings GROUP BY user_id")
def user_last_item(spark, d):
    return uf.last_item(cv.ratings(spark, d))


@query(
    "profile_updates",
    """SELECT user_id, round(avg(rating), 6) AS average_rating, greatest(0.0, max(rating)) AS highest_rating,
              least(5.0, min(rating)) AS lowest_rating, count(*) AS rating_count, arg_max(item_id, (ts, item_id)) AS item_id
       FROM ratings GROUP BY user_id""",
)
def profile_updates(spark, d):
    """The ratings of even days folded into a written state, those of odd days added to it."""
    r = cv.ratings(spark, d)
    day = F.col("ts") / cv.EPOCH_DAY_SECONDS
    kept = written(profiles.profile_state(r.where(day % 2 == 0)))
    return profiles.profile_of(profiles.merge_states(kept, profiles.profile_state(r.where(day % 2 != 0))))


_LAST_SQL = "last_item AS (SELECT user_id, arg_max(item_id, (ts, item_id)) AS item_id FROM ratings GROUP BY user_id)"


@query(
    "user_history_genres",
    f"""SELECT DISTINCT l.user_id, g.genre FROM last_item l
        JOIN (SELECT item_id, unnest({sql_genre_list('genres')}) AS genre FROM items) g ON l.item_id = g.item_id""",
    _LAST_SQL,
)
def user_history_genres(spark, d):
    r, i = views(spark, d)
    return uf.user_history_genres(r, i)


@query("distinct_users", "SELECT DISTINCT user_id FROM ratings")
def distinct_users(spark, d):
    return cv.ratings(spark, d).select("user_id").distinct()


@query(
    "explode_genres",
    f"SELECT item_id, unnest({sql_genre_pieces('genres')}) AS genre FROM ({BLANKED_ITEMS_SQL}) i",
)
def explode_genres(spark, d):
    return blanked_items(spark, d).select("item_id", F.explode(genre_pieces("genres")).alias("genre"))


@query(
    "genre_index",
    f"""SELECT genre, item_id, count(*) OVER (PARTITION BY genre) AS item_count
        FROM (SELECT DISTINCT item_id, unnest({sql_genre_list('genres')}) AS genre FROM items) g""",
)
def genre_index(spark, d):
    from reelsift.operators.recall import genre_index as gi

    return gi(cv.items(spark, d))


_ITEM_FEAT_COLS = """user_id, item_id, rating, ts, label, release_year, genres, movie_genre1, movie_genre2, movie_genre3,
       movie_rating_count, movie_avg_rating, movie_rating_stddev"""


def _item_feats(spark, d):
    r, i = kept_views(spark, d)
    return itf.add_item_features(smp.add_label(r), i)


@query("item_features", f"SELECT {_ITEM_FEAT_COLS} FROM item_feats", LABELLED_SQL, ITEM_FEATURES_SQL)
def item_features(spark, d):
    return _item_feats(spark, d)


_UF_OUT = """user_id, item_id, rating, ts, label,
       user_rated_movie1, user_rated_movie2, user_rated_movie3, user_rated_movie4, user_rated_movie5,
       user_rating_count, user_avg_release_year, user_release_year_stddev, user_avg_rating, user_rating_stddev,
       user_genre1, user_genre2, user_genre3, user_genre4, user_genre5"""


def _user_feats(spark, d, history):
    from reelsift.operators.training import build_samples

    r, i = kept_views(spark, d)
    return build_samples(r, i, history=history)


@query("user_features", f"SELECT {_UF_OUT} FROM user_feats", LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))
def user_features(spark, d):
    return _user_feats(spark, d, 100).select(*[c.strip() for c in _UF_OUT.split(",")])


@query("user_features_h20", f"SELECT {_UF_OUT} FROM user_feats", LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(20))
def user_features_h20(spark, d):
    return _user_feats(spark, d, 20).select(*[c.strip() for c in _UF_OUT.split(",")])


_SAMPLE_COLS = _UF_OUT.replace("label,", "label, release_year, movie_genre1, movie_genre2, movie_genre3, movie_rating_count, movie_avg_rating, movie_rating_stddev,")


@query("training_samples", f"SELECT {_SAMPLE_COLS} FROM user_feats", LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))
def training_samples(spark, d):
    from reelsift.operators.training import build_samples

    r, i = kept_views(spark, d)
    return build_samples(r, i)


@query(
    "filter_min_history",
    "SELECT user_id, item_id, user_rating_count FROM user_feats",
    LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100),
)
def filter_min_history(spark, d):
    return _user_feats(spark, d, 100).select("user_id", "item_id", "user_rating_count")


LATEST_ITEM_SQL = """SELECT item_id, release_year, coalesce(movie_genre1, '') AS movie_genre1,
       coalesce(movie_genre2, '') AS movie_genre2, coalesce(movie_genre3, '') AS movie_genre3,
       movie_rating_count, movie_avg_rating, movie_rating_stddev
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, user_id DESC) AS rn FROM user_feats) x
WHERE rn = 1"""


@query("latest_item_features", LATEST_ITEM_SQL, LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))
def latest_item_features(spark, d):
    return itf.latest_item_features(training_samples(spark, d))


LATEST_USER_SQL = """SELECT user_id, user_rated_movie1, user_rated_movie2, user_rated_movie3, user_rated_movie4,
       user_rated_movie5, user_rating_count, user_avg_release_year, user_release_year_stddev, user_avg_rating,
       user_rating_stddev, user_genre1, user_genre2, user_genre3, user_genre4, user_genre5
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS rn FROM user_feats) x
WHERE rn = 1"""


@query("latest_user_features", LATEST_USER_SQL, LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))
def latest_user_features(spark, d):
    return uf.latest_user_features(training_samples(spark, d))


# ---- the seven point-in-time windows, one query each (W1-W7) ---------------------

def _win(spark, d, *cols):
    return _user_feats(spark, d, 100).select("user_id", "item_id", *cols)


_WIN_CTES = (LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))


@query("win_positive_history",
       """SELECT user_id, item_id, array_to_string(list_reverse(_hist), ',') AS positive_history, len(_hist) AS history_length
          FROM uf_genres WHERE user_rating_count > 1""",
       *_WIN_CTES)
def win_positive_history(spark, d):
    f = uf.add_user_features(_item_feats(spark, d), lists=True)
    text = F.array_join(F.transform("positive_history", lambda x: x.cast("string")), ",")
    return f.select("user_id", "item_id", text.alias("positive_history"), F.size("positive_history").alias("history_length"))


@query("win_rating_count", "SELECT user_id, item_id, user_rating_count FROM user_feats", *_WIN_CTES)
def win_rating_count(spark, d):
    return _win(spark, d, "user_rating_count")


@query("win_avg_year", "SELECT user_id, item_id, user_avg_release_year FROM user_feats", *_WIN_CTES)
def win_avg_year(spark, d):
    return _win(spark, d, "user_avg_release_year")


@query("win_year_stddev", "SELECT user_id, item_id, user_release_year_stddev FROM user_feats", *_WIN_CTES)
def win_year_stddev(spark, d):
    return _win(spark, d, "user_release_year_stddev")


@query("win_avg_rating", "SELECT user_id, item_id, user_avg_rating FROM user_feats", *_WIN_CTES)
def win_avg_rating(spark, d):
    return _win(spark, d, "user_avg_rating")


@query("win_rating_stddev", "SELECT user_id, item_id, user_rating_stddev FROM user_feats", *_WIN_CTES)
def win_rating_stddev(spark, d):
    return _win(spark, d, "user_rating_stddev")


@query("win_user_genres",
       "SELECT user_id, item_id, array_to_string(_genres, ',') AS preferred_genres, len(_genres) AS n_genres FROM uf_genres WHERE user_rating_count > 1",
       *_WIN_CTES)
def win_user_genres(spark, d):
    f = uf.add_user_features(_item_feats(spark, d), lists=True)
    return f.select("user_id", "item_id", F.array_join("preferred_genres", ",").alias("preferred_genres"), F.size("preferred_genres").alias("n_genres"))
