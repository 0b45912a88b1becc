"""Catalog: embeddings without training, recall, scoring and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsift.operators import embedding as emb
from reelsift.operators import rank as rk
from reelsift.operators import recall as rc
from reelsift.operators.item_features import item_profile
from reelsift.plans.common import kept_views, sql_genre_list, sql_uniform, sql_year
from reelsift.plans.registry import query
from reelsift.sources import canonical as cv


def sql_cos100(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    den = f"(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})))"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL OR len({a}) <> len({b}) OR {den} = 0 THEN NULL "
            f"ELSE list_inner_product({a}, {b}) / {den} * 100 END)")


PROFILE_SQL = f"""
profile AS (
  SELECT i.item_id, {sql_year('i.title', '0', '0')} AS release_year, {sql_genre_list('i.genres')} AS genre_list,
         coalesce(s.a, 0) AS average_rating
  FROM items i LEFT JOIN (SELECT item_id, avg(rating) AS a FROM ratings GROUP BY item_id) s ON i.item_id = s.item_id)"""

CHANNELS_SQL = """
genre_top AS (
  SELECT genre, item_id, row_number() OVER (PARTITION BY genre ORDER BY average_rating DESC, item_id) AS genre_rank
  FROM (SELECT item_id, average_rating, unnest(genre_list) AS genre FROM profile) g
  QUALIFY genre_rank <= 20),
channels AS (
  SELECT 'g:' || genre AS key, item_id, 'genre' AS channel FROM genre_top
  UNION ALL SELECT '#top_rating', item_id, 'top_rating' FROM (SELECT item_id FROM profile ORDER BY average_rating DESC, item_id LIMIT 100) a
  UNION ALL SELECT '#top_year', item_id, 'latest' FROM (SELECT item_id FROM profile ORDER BY release_year DESC, item_id LIMIT 100) b),
hist AS (SELECT user_id, arg_max(item_id, (ts, item_id)) AS history_item FROM ratings GROUP BY user_id)"""

UKEYS_SQL = f"""
ukeys_genre AS (
  SELECT h.user_id, h.history_item, 'g:' || unnest(g.gl) AS key
  FROM hist h JOIN (SELECT item_id, {sql_genre_list('genres')} AS gl FROM items) g ON h.history_item = g.item_id),
ukeys AS (
  SELECT user_id, history_item, key FROM ukeys_genre
  UNION SELECT user_id, history_item, '#top_rating' FROM hist
  UNION SELECT user_id, history_item, '#top_year' FROM hist),
cands AS (
  SELECT k.user_id, k.history_item, c.item_id, list_sort(list_distinct(list(c.channel))) AS channels
  FROM ukeys k JOIN channels c ON k.key = c.key
  WHERE c.item_id <> k.history_item
  GROUP BY k.user_id, k.history_item, c.item_id)"""

UEMB_SQL = """
emb_long AS (SELECT item_id, unnest(emb) AS v, generate_subscripts(emb, 1) AS d FROM item_emb),
ucount AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id),
usum AS (SELECT r.user_id, x.d, sum(CAST(x.v AS DOUBLE)) AS s FROM ratings r JOIN emb_long x ON r.item_id = x.item_id GROUP BY r.user_id, x.d),
dims AS (SELECT DISTINCT d FROM emb_long),
uemb_long AS (SELECT c.user_id, dims.d, coalesce(u.s, 0) / c.n AS v
              FROM ucount c JOIN dims ON true LEFT JOIN usum u ON u.user_id = c.user_id AND u.d = dims.d),
uemb AS (SELECT user_id, list(v ORDER BY d) AS emb FROM uemb_long GROUP BY user_id)"""

RECALL_CTES = (PROFILE_SQL, CHANNELS_SQL, UKEYS_SQL)


def _recall(spark, d, **kw):
    r, i = kept_views(spark, d)
    return rc.recall(r, i, **kw)


def _candidates(r, i, ie, mode):
    sides, per_row = rk.item_sides(i, r, ie, mode)
    return rc.recall(r, i, with_channels=False, sides=sides, side_bytes=per_row)


def _chan(c="channels"):
    return F.array_join(c, ",").alias("channels")


@query("top_items_by_rating",
       "SELECT item_id, round(average_rating, 6) AS average_rating, row_number() OVER (ORDER BY average_rating DESC, item_id) AS top_rank FROM profile ORDER BY average_rating DESC, item_id LIMIT 100",
       PROFILE_SQL)
def top_items_by_rating(spark, d):
    r, i = kept_views(spark, d)
    return rc.top_items(item_profile(i, r), 100, "rating").select("item_id", "average_rating", "top_rank")


@query("top_items_by_year",
       "SELECT item_id, release_year, row_number() OVER (ORDER BY release_year DESC, item_id) AS top_rank FROM profile ORDER BY release_year DESC, item_id LIMIT 100",
       PROFILE_SQL)
def top_items_by_year(spark, d):
    r, i = kept_views(spark, d)
    return rc.top_items(item_profile(i, r), 100, "releaseYear").select("item_id", "release_year", "top_rank")


@query("top_items_per_genre", "SELECT genre, item_id, genre_rank FROM genre_top", PROFILE_SQL, CHANNELS_SQL)
def top_items_per_genre(spark, d):
    r, i = kept_views(spark, d)
    return rc.top_items_per_genre(item_profile(i, r), 20).select("genre", "item_id", "genre_rank")


@query("recall_by_genre",
       "SELECT DISTINCT k.user_id, c.item_id FROM ukeys_genre k JOIN channels c ON k.key = c.key",
       *RECALL_CTES)
def recall_by_genre(spark, d):
    return _recall(spark, d, with_global=False, remove_history=False).select("user_id", "item_id")


@query("recall_global",
       "SELECT DISTINCT h.user_id, c.item_id FROM hist h JOIN channels c ON c.key IN ('#top_rating', '#top_year')",
       *RECALL_CTES)
def recall_global(spark, d):
    return _recall(spark, d, with_genres=False, remove_history=False).select("user_id", "item_id")


@query("recall_minus_history", "SELECT user_id, item_id FROM cands", *RECALL_CTES)
def recall_minus_history(spark, d):
    return _recall(spark, d).select("user_id", "item_id")


@query("recall_union", "SELECT user_id, item_id, array_to_string(channels, ',') AS channels FROM cands", *RECALL_CTES)
def recall_union(spark, d):
    return _recall(spark, d).select("user_id", "item_id", _chan())


@query("recall_multi", "SELECT user_id, history_item, item_id, array_to_string(channels, ',') AS channels FROM cands", *RECALL_CTES)
def recall_multi(spark, d):
    return _recall(spark, d).select("user_id", "history_item", "item_id", _chan())


@query("user_embedding", "SELECT user_id, d - 1 AS dim, round(v, 6) AS value FROM uemb_long", UEMB_SQL)
def user_embedding(spark, d):
    r, _ = kept_views(spark, d)
    ie = cv.item_emb(spark, d)
    u = emb.user_embeddings(r, ie, dim=emb.embedding_dim(ie))
    return u.select("user_id", F.posexplode("emb").alias("dim", "value"))


@query("item_sequences",
       "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos, item_id FROM ratings WHERE rating >= 3.5")
def item_sequences(spark, d):
    return emb.item_sequences(cv.ratings(spark, d))


@query("sequence_string",
       """SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY ts, item_id) AS item_seq, count(*) AS seq_len
          FROM ratings WHERE rating >= 3.5 GROUP BY user_id""")
def sequence_string(spark, d):
    return emb.sequence_strings(emb.item_sequences(cv.ratings(spark, d)))


PAIRS_SQL = f"""
pairs AS (
  SELECT r.user_id, r.item_id, r.rating, u.emb AS u_emb, e.emb AS i_emb
  FROM ratings r SEMI JOIN items i ON r.item_id = i.item_id
  LEFT JOIN uemb u ON r.user_id = u.user_id LEFT JOIN item_emb e ON r.item_id = e.item_id)"""


def _pair_frames(spark, d):
    r, i = kept_views(spark, d)
    ie = cv.item_emb(spark, d)
    ue = emb.user_embeddings(r, ie)
    return r, i, ie, ue


@query("cosine_scores", f"SELECT user_id, item_id, round({sql_cos100('u_emb', 'i_emb')}, 6) AS cosine FROM pairs", UEMB_SQL, PAIRS_SQL)
def cosine_scores(spark, d):
    r, i, ie, ue = _pair_frames(spark, d)
    return rk.pair_cosines(r, i, ue, ie)


@query("pair_scores",
       f"SELECT user_id, item_id, rating, round(coalesce({sql_cos100('u_emb', 'i_emb')}, -1), 6) AS score FROM pairs",
       UEMB_SQL, PAIRS_SQL)
def pair_scores(spark, d):
    r, i, ie, ue = _pair_frames(spark, d)
    return rk.score_pairs(r, r, i, ue, ie)


@query("user_item_scores",
       f"SELECT user_id, item_id, round(coalesce({sql_cos100('u_emb', 'i_emb')}, -1), 6) AS score FROM pairs",
       UEMB_SQL, PAIRS_SQL)
def user_item_scores(spark, d):
    r, i, ie, ue = _pair_frames(spark, d)
    return rk.score_pairs(r, r, i, ue, ie).select("user_id", "item_id", "score")


def _banded_sql() -> str:
    s = f"coalesce({sql_cos100('u_emb', 'i_emb')}, -1)"
    u = sql_uniform(["user_id", "item_id"], 0)
    band = (f"CASE WHEN rating >= 4 THEN 80 + {u} * 10 WHEN rating >= 3 AND rating < 4 THEN 65 + {u} * 15 "
            f"WHEN rating > 2 AND rating < 3 THEN 45 + {u} * 15 WHEN rating <= 2 THEN {u} * 45 END")
    return (f"SELECT user_id, item_id, rating, round(CASE WHEN {s} < 0 THEN {band} ELSE {s} END, 6) AS score, "
            f"{s} < 0 AS is_fallback FROM pairs")


@query("pair_scores_banded", _banded_sql(), UEMB_SQL, PAIRS_SQL)
def pair_scores_banded(spark, d):
    r, i, ie, ue = _pair_frames(spark, d)
    return rk.score_pairs(r, r, i, ue, ie, banded=True, seed=0)


SCORED_SQL = f"""
scored AS (
  SELECT c.user_id, c.item_id, coalesce({sql_cos100('u.emb', 'e.emb')}, -1) AS score,
         {sql_cos100('u.emb', 'e.emb')} IS NULL AS missing
  FROM cands c LEFT JOIN uemb u ON c.user_id = u.user_id LEFT JOIN item_emb e ON c.item_id = e.item_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank FROM scored)"""


@query("rank_users_embedding", "SELECT user_id, item_id, round(score, 6) AS score, rank FROM ranked", *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def rank_users_embedding(spark, d):
    r, i, ie, ue = _pair_frames(spark, d)
    return rk.rank_within(rk.score_candidates(r, i, ie, ue), "user_id", rounded=True).select("user_id", "item_id", "score", "rank")


@query("rank_users_positional",
       """SELECT user_id, item_id, CAST(count(*) OVER (PARTITION BY user_id) - row_number() OVER (PARTITION BY user_id ORDER BY item_id) + 1 AS DOUBLE) AS score,
                 row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rank
          FROM cands""",
       *RECALL_CTES)
def rank_users_positional(spark, d):
    r, i = kept_views(spark, d)
    c = rc.recall(r, i).select("user_id", "item_id")
    return rk.rank_for_users(c, None, None, "positional").select("user_id", "item_id", "score", "rank")


@query("recommend_top5", "SELECT user_id, item_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 5", *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def recommend_top5(spark, d):
    r, i = kept_views(spark, d)
    return rk.recommend(r, i, cv.item_emb(spark, d), k=5, rounded=True)


@query("recommend_all_users", "SELECT user_id, item_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 5", *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def recommend_all_users(spark, d):
    r, i = kept_views(spark, d)
    users = r.select("user_id").distinct()
    recs = rk.recommend(r, i, cv.item_emb(spark, d), k=5, rounded=True)
    return recs.join(users, "user_id", "left_semi")


def _fallback_sql() -> str:
    u = sql_uniform(["user_id", "item_id"], 0)
    return f"""SELECT user_id, item_id, round(score, 6) AS score, is_fallback,
                  row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank
           FROM (SELECT user_id, item_id, CASE WHEN missing THEN {u} * 100 ELSE score END AS score,
                        missing AS is_fallback
                 FROM ranked WHERE rank <= 5) x"""


@query("recommend_with_fallback", _fallback_sql(), *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def recommend_with_fallback(spark, d):
    r, i = kept_views(spark, d)
    return rk.recommend(r, i, cv.item_emb(spark, d), k=5, fallback=True, seed=0, rounded=True).select("user_id", "item_id", "score", "is_fallback", "rank")


_ITEM_PAIR_SQL = f"""
item_scored AS (
  SELECT c.user_id, c.item_id, coalesce({sql_cos100('h.emb', 'e.emb')}, -1) AS score
  FROM cands c LEFT JOIN item_emb h ON c.history_item = h.item_id LEFT JOIN item_emb e ON c.item_id = e.item_id)"""


@query("item_item_scores", "SELECT user_id, item_id, round(score, 6) AS score FROM item_scored", *RECALL_CTES, _ITEM_PAIR_SQL)
def item_item_scores(spark, d):
    r, i = kept_views(spark, d)
    return rk.rank_items(_candidates(r, i, cv.item_emb(spark, d), "embedding"), i, r, cv.item_emb(spark, d), "embedding").select("user_id", "item_id", "score")


@query("rank_items_embedding",
       """SELECT user_id, item_id, round(score, 6) AS score,
                 row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank FROM item_scored""",
       *RECALL_CTES, _ITEM_PAIR_SQL)
def rank_items_embedding(spark, d):
    r, i = kept_views(spark, d)
    return rk.rank_items(_candidates(r, i, cv.item_emb(spark, d), "embedding"), i, r, cv.item_emb(spark, d), "embedding", rounded=True).select("user_id", "item_id", "score", "rank")


_CONTENT_SQL = """
content AS (
  SELECT c.user_id, c.item_id,
         (CASE WHEN len(coalesce(h.genre_list, [])) + len(coalesce(p.genre_list, [])) = 0 THEN 0.0
               ELSE len(list_filter(coalesce(h.genre_list, []), lambda g: list_contains(coalesce(p.genre_list, []), g)))
                    / (len(coalesce(h.genre_list, [])) + len(coalesce(p.genre_list, []))) / 2 END) * 0.7
         + coalesce(p.average_rating, 0) / 5 * 0.3 AS score
  FROM cands c LEFT JOIN profile h ON c.history_item = h.item_id LEFT JOIN profile p ON c.item_id = p.item_id)"""


@query("rank_items_content",
       """SELECT user_id, item_id, round(score, 6) AS score,
                 row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank FROM content""",
       *RECALL_CTES, _CONTENT_SQL)
def rank_items_content(spark, d):
    r, i = kept_views(spark, d)
    return rk.rank_items(_candidates(r, i, cv.item_emb(spark, d), "content"), i, r, cv.item_emb(spark, d), "content", rounded=True).select("user_id", "item_id", "score", "rank")


@query("content_similarity", "SELECT user_id, item_id, round(score, 6) AS score FROM content", *RECALL_CTES, _CONTENT_SQL)
def content_similarity(spark, d):
    return rank_items_content(spark, d).select("user_id", "item_id", "score")


_UKEYS_ALL_SQL = f"""
ukeys_all AS (
  SELECT DISTINCT r.user_id, 'g:' || unnest(g.gl) AS key
  FROM ratings r JOIN (SELECT item_id, {sql_genre_list('genres')} AS gl FROM items) g ON r.item_id = g.item_id
  UNION SELECT user_id, '#top_rating' FROM hist
  UNION SELECT user_id, '#top_year' FROM hist)"""


@query("recall_history_all",
       """SELECT DISTINCT k.user_id, c.item_id FROM ukeys_all k JOIN channels c ON k.key = c.key
          WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = k.user_id AND r.item_id = c.item_id)""",
       PROFILE_SQL, CHANNELS_SQL, _UKEYS_ALL_SQL)
def recall_history_all(spark, d):
    """R9 with the whole history: genres of every rated item, every rated item removed."""
    return _recall(spark, d, history="all", with_channels=False).select("user_id", "item_id")
