"""Catalog: sources and sinks (write -> read back round trips), projections and joins.

Round trips write into a fresh folder under the session's shared checkpoint
folder (``scratch_dir``), never a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsift.functions import clean_title, fmt2, genre_array, genre_slot, release_year
from reelsift.operators import embedding as emb
from reelsift.operators import item_features as itf
from reelsift.operators import rank as rk
from reelsift.operators import user_features as uf
from reelsift.operators.cf import cast_ratings
from reelsift.plans.catalog_features import (
    LATEST_ITEM_SQL,
    LATEST_USER_SQL,
    _item_feats,
    _user_feats,
    training_samples,
)
from reelsift.plans.catalog_recall import PAIRS_SQL, RECALL_CTES, SCORED_SQL, UEMB_SQL, _fallback_sql, sql_cos100
from reelsift.plans.common import (
    ITEM_FEATURES_SQL,
    LABELLED_SQL,
    kept_views,
    sql_fmt2,
    sql_genre_list,
    sql_uniform,
    sql_year,
    user_features_sql,
    views,
)
from reelsift.plans.registry import query
from reelsift.session import scratch_dir
from reelsift.sinks import files as sk
from reelsift.sinks import kv as skv
from reelsift.sources import canonical as cv
from reelsift.sources import files as src
from reelsift.sources import kv as skr

_EMB_LONG = "SELECT item_id, generate_subscripts(emb, 1) - 1 AS dim, round(CAST(unnest(emb) AS DOUBLE), 6) AS value FROM item_emb"


def _user_vectors(spark, d):
    ie = cv.item_emb(spark, d)
    return emb.user_embeddings(cv.ratings(spark, d), ie, dim=emb.embedding_dim(ie))


def _long(df, id_col):
    return df.select(id_col, F.posexplode("emb").alias("dim", "value"))


def _ratings_csv(spark, d):
    path = scratch_dir(spark) + "/ratings_csv"
    r = cv.ratings(spark, d)
    sk.write_samples(r.select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating",
                              F.col("ts").alias("timestamp")), path)
    return path


def _items_csv(spark, d):
    path = scratch_dir(spark) + "/items_csv"
    i = cv.items(spark, d)
    sk.write_samples(i.select(F.col("item_id").alias("movieId"), "title", "genres"), path)
    return path


@query("src_ratings_csv", "SELECT user_id, item_id, rating, ts FROM ratings")
def src_ratings_csv(spark, d):
    return src.read_ratings_csv(spark, _ratings_csv(spark, d))


@query("src_items_csv", "SELECT item_id, title, genres FROM items")
def src_items_csv(spark, d):
    return src.read_items_csv(spark, _items_csv(spark, d))


_T = "trim(title)"
_HAS_YEAR = f"(length({_T}) >= 6 AND TRY_CAST(substr({_T}, length({_T}) - 4, 4) AS INTEGER) IS NOT NULL)"
_STRICT_ITEMS = f"""SELECT item_id,
       CASE WHEN {_HAS_YEAR} THEN trim(substr({_T}, 1, length({_T}) - 6)) ELSE {_T} END AS title,
       {sql_year('title', '0', '0')} AS release_year,
       len({sql_genre_list('genres')}) AS genre_count,
       array_to_string({sql_genre_list('genres')}, '|') AS genre_text
FROM items"""


@query("src_items_strict", _STRICT_ITEMS)
def src_items_strict(spark, d):
    s = src.load_items_strict(spark, _items_csv(spark, d))
    return s.select("item_id", "title", "release_year", F.size("genre_list").alias("genre_count"),
                    F.array_join("genre_list", "|").alias("genre_text"))


@query("src_ratings_strict", "SELECT user_id, item_id, rating, ts FROM ratings")
def src_ratings_strict(spark, d):
    return src.load_ratings_strict(spark, _ratings_csv(spark, d))


@query("src_links", "SELECT item_id, imdb_id, tmdb_id FROM links")
def src_links(spark, d):
    path = scratch_dir(spark) + "/links_csv"
    l = cv.links(spark, d)
    sk.write_samples(l.select(F.col("item_id").alias("movieId"), F.col("imdb_id").alias("imdbId"), F.col("tmdb_id").alias("tmdbId")), path)
    return src.load_links(spark, path)


@query("src_item_emb", _EMB_LONG)
def src_item_emb(spark, d):
    path = scratch_dir(spark) + "/item_emb_txt"
    sk.write_embeddings(cv.item_emb(spark, d), path, "item_id")
    return _long(src.read_embeddings(spark, path, "item_id"), "item_id")


@query("src_user_emb",
       "SELECT user_id, d - 1 AS dim, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 6) AS value FROM uemb_long", UEMB_SQL)
def src_user_emb(spark, d):
    path = scratch_dir(spark) + "/user_emb_txt"
    ue = _user_vectors(spark, d)
    sk.write_embeddings(ue, path, "user_id")
    return _long(src.read_embeddings(spark, path, "user_id"), "user_id")


@query("src_emb_last_wins",
       """SELECT item_id, generate_subscripts(e, 1) - 1 AS dim, round(CAST(unnest(e) AS DOUBLE), 6) AS value
          FROM (SELECT item_id, CASE WHEN emb[1] > 0 THEN list_reverse(emb) ELSE emb END AS e FROM item_emb) x""")
def src_emb_last_wins(spark, d):
    base = scratch_dir(spark)
    ie = cv.item_emb(spark, d)
    sk.write_embeddings(ie, base + "/a", "item_id")
    sk.write_embeddings(ie.where(F.get("emb", 0) > 0).select("item_id", F.reverse("emb").alias("emb")), base + "/b", "item_id")
    return _long(src.read_embeddings_multi(spark, [base + "/a", base + "/b"], "item_id"), "item_id")


def _kv_item_emb(spark, d, as_of=None):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.to_kv_embeddings(cv.item_emb(spark, d), skv.ITEM_EMB_PREFIX, "item_id", as_of=as_of), path)
    return path


@query("src_kv_emb", _EMB_LONG)
def src_kv_emb(spark, d):
    path = _kv_item_emb(spark, d)
    return _long(skr.read_kv_embeddings(spark, path, skv.ITEM_EMB_PREFIX, "item_id"), "item_id")


@query("src_switch",
       f"SELECT 'file' AS source, * FROM ({_EMB_LONG}) a UNION ALL SELECT 'kv' AS source, * FROM ({_EMB_LONG}) b")
def src_switch(spark, d):
    base = scratch_dir(spark)
    sk.write_embeddings(cv.item_emb(spark, d), base + "/txt", "item_id")
    kvp = _kv_item_emb(spark, d)
    f = _long(skr.load_embeddings(spark, "file", base + "/txt"), "item_id").withColumn("source", F.lit("file"))
    k = _long(skr.load_embeddings(spark, "kv", kvp, skv.ITEM_EMB_PREFIX), "item_id").withColumn("source", F.lit("kv"))
    return f.unionByName(k).select("source", "item_id", "dim", "value")


def _unpivot_sql(source_sql: str, id_col: str, prefix: str, fields) -> str:
    names = ", ".join(f"'{n}'" for n, _ in fields)
    vals = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for _, c in fields)
    return f"""SELECT '{prefix}:' || CAST({id_col} AS VARCHAR) AS key, unnest([{names}]) AS field, unnest([{vals}]) AS value
FROM ({source_sql}) s"""


_FEATS = (LABELLED_SQL, ITEM_FEATURES_SQL, user_features_sql(100))


def _explode_features(kv):
    return kv.select("key", F.explode("features").alias("field", "value"))


@query("sink_kv_item_features", _unpivot_sql(LATEST_ITEM_SQL, "item_id", "mf", skv.ITEM_FEATURE_FIELDS), *_FEATS)
def sink_kv_item_features(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.item_feature_kv(itf.latest_item_features(training_samples(spark, d))), path)
    return _explode_features(skr.read_kv(spark, path, skv.ITEM_FEATURE_PREFIX))


@query("sink_kv_user_features", _unpivot_sql(LATEST_USER_SQL, "user_id", "uf", skv.USER_FEATURE_FIELDS), *_FEATS)
def sink_kv_user_features(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.user_feature_kv(uf.latest_user_features(training_samples(spark, d))), path)
    return _explode_features(skr.read_kv(spark, path, skv.USER_FEATURE_PREFIX))


@query("src_kv_features",
       f"SELECT CAST(split_part(key, ':', 2) AS BIGINT) AS item_id, field, value FROM ({_unpivot_sql(LATEST_ITEM_SQL, 'item_id', 'mf', skv.ITEM_FEATURE_FIELDS)}) u",
       *_FEATS)
def src_kv_features(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.item_feature_kv(itf.latest_item_features(training_samples(spark, d))), path)
    f = skr.read_kv_features(spark, path, skv.ITEM_FEATURE_PREFIX, "item_id")
    return f.select("item_id", F.explode("features").alias("field", "value"))


_ITEM_KV_SQL = _unpivot_sql(LATEST_ITEM_SQL, "item_id", "mf", skv.ITEM_FEATURE_FIELDS)
_USER_KV_SQL = _unpivot_sql(LATEST_USER_SQL, "user_id", "uf", skv.USER_FEATURE_FIELDS)


def _user_kv(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.user_feature_kv(uf.latest_user_features(training_samples(spark, d))), path)
    return path


@query("src_kv_user_features", f"SELECT CAST(split_part(key, ':', 2) AS BIGINT) AS user_id, field, value FROM ({_USER_KV_SQL}) u", *_FEATS)
def src_kv_user_features(spark, d):
    f = skr.read_kv_features(spark, _user_kv(spark, d), skv.USER_FEATURE_PREFIX, "user_id")
    return f.select("user_id", F.explode("features").alias("field", "value"))


@query("join_kv_features",
       f"SELECT i.item_id, u.field, u.value FROM items i LEFT JOIN ({_ITEM_KV_SQL}) u ON u.key = 'mf:' || CAST(i.item_id AS VARCHAR)",
       *_FEATS)
def join_kv_features(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.item_feature_kv(itf.latest_item_features(training_samples(spark, d))), path)
    f = skr.read_kv_features(spark, path, skv.ITEM_FEATURE_PREFIX, "item_id")
    return skr.join_features(cv.items(spark, d).select("item_id"), f).select("item_id", F.explode_outer("features").alias("field", "value"))


@query("join_kv_user_features",
       f"SELECT x.user_id, u.field, u.value FROM (SELECT DISTINCT user_id FROM ratings) x LEFT JOIN ({_USER_KV_SQL}) u ON u.key = 'uf:' || CAST(x.user_id AS VARCHAR)",
       *_FEATS)
def join_kv_user_features(spark, d):
    f = skr.read_kv_features(spark, _user_kv(spark, d), skv.USER_FEATURE_PREFIX, "user_id")
    users = cv.ratings(spark, d).select("user_id").distinct()
    return skr.join_features(users, f, "user_id").select("user_id", F.explode_outer("features").alias("field", "value"))


@query("src_feature_switch", f"SELECT true AS enabled, key, field, value FROM ({_ITEM_KV_SQL}) u", *_FEATS)
def src_feature_switch(spark, d):
    """Loaded with the switch on, and (no rows) with it off."""
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.item_feature_kv(itf.latest_item_features(training_samples(spark, d))), path)
    parts = [
        skr.load_features(spark, on, path, skv.ITEM_FEATURE_PREFIX).select(
            F.lit(on).alias("enabled"), F.concat(F.lit("mf:"), F.col("item_id").cast("string")).alias("key"), F.explode("features").alias("field", "value"))
        for on in (True, False)
    ]
    return parts[0].unionByName(parts[1])


@query("sink_kv_overwrite", f"""SELECT 'i2vEmb:' || CAST(item_id AS VARCHAR) AS key, generate_subscripts(emb, 1) - 1 AS dim,
         round(CAST(unnest(emb) AS DOUBLE) * CASE WHEN item_id % 2 = 0 THEN 2 ELSE 1 END, 6) AS value FROM item_emb""")
def sink_kv_overwrite(spark, d):
    """All items written, then the even ones again with doubled vectors: one entry a key, the later one."""
    path = scratch_dir(spark) + "/kv"
    ie = cv.item_emb(spark, d)
    skv.write_kv(skv.to_kv_embeddings(ie, skv.ITEM_EMB_PREFIX, "item_id"), path)
    again = ie.where(F.col("item_id") % 2 == 0).withColumn("emb", F.transform("emb", lambda x: x * 2))
    skv.write_kv(skv.to_kv_embeddings(again, skv.ITEM_EMB_PREFIX, "item_id"), path)
    return _kv_values(skr.read_kv(spark, path, skv.ITEM_EMB_PREFIX))


def _kv_values(kv, *keep: str):
    v = kv.select("key", *keep, F.posexplode(F.split("value", " ")).alias("dim", "v"))
    return v.select("key", *keep, "dim", F.col("v").cast("float").alias("value"))


@query("sink_samples_csv",
       "SELECT * FROM user_feats", *_FEATS)
def sink_samples_csv(spark, d):
    path = scratch_dir(spark) + "/samples"
    s = training_samples(spark, d)
    sk.write_samples(s, path)
    return spark.read.schema(s.schema).option("header", True).csv(path)


def _text_values(spark, path, id_col: str):
    p = F.split(F.col("value"), ":")
    v = spark.read.text(path).select(F.get(p, 0).cast("bigint").alias(id_col), F.posexplode(F.split(F.get(p, 1), " ")).alias("dim", "v"))
    return v.select(id_col, "dim", F.col("v").cast("float").alias("value"))


@query("sink_item_emb", "SELECT item_id, generate_subscripts(emb, 1) - 1 AS dim, round(CAST(unnest(emb) AS DOUBLE), 6) AS value FROM item_emb")
def sink_item_emb(spark, d):
    path = scratch_dir(spark) + "/item_emb_txt"
    sk.write_embeddings(cv.item_emb(spark, d), path, "item_id")
    return _text_values(spark, path, "item_id")


@query("sink_user_emb", "SELECT user_id, d - 1 AS dim, round(CAST(v AS FLOAT)::DOUBLE, 6) AS value FROM uemb_long", UEMB_SQL)
def sink_user_emb(spark, d):
    path = scratch_dir(spark) + "/user_emb_txt"
    sk.write_embeddings(_user_vectors(spark, d), path, "user_id")
    return _text_values(spark, path, "user_id")


_ASOF = "(SELECT max(ts) FROM ratings)"


def _as_of(spark, d):
    return int(cv.ratings(spark, d).agg(F.max("ts")).first()[0])


@query("sink_kv_item_emb",
       f"""SELECT 'i2vEmb:' || CAST(item_id AS VARCHAR) AS key, {_ASOF} + 86400 AS expires_at,
                  generate_subscripts(emb, 1) - 1 AS dim, round(CAST(unnest(emb) AS DOUBLE), 6) AS value FROM item_emb""")
def sink_kv_item_emb(spark, d):
    path = _kv_item_emb(spark, d, as_of=_as_of(spark, d))
    return _kv_values(skr.read_kv(spark, path, skv.ITEM_EMB_PREFIX), "expires_at")


@query("sink_kv_user_emb",
       f"""SELECT 'uEmb:' || CAST(user_id AS VARCHAR) AS key, {_ASOF} + 86400 AS expires_at, d - 1 AS dim,
                  round(CAST(v AS FLOAT)::DOUBLE, 6) AS value FROM uemb_long""",
       UEMB_SQL)
def sink_kv_user_emb(spark, d):
    path = scratch_dir(spark) + "/kv"
    ue = _user_vectors(spark, d)
    skv.write_kv(skv.to_kv_embeddings(ue, skv.USER_EMB_PREFIX, "user_id", as_of=_as_of(spark, d)), path)
    return _kv_values(skr.read_kv(spark, path, skv.USER_EMB_PREFIX), "expires_at")


@query("src_kv_user_emb", "SELECT user_id, d - 1 AS dim, round(CAST(v AS FLOAT)::DOUBLE, 6) AS value FROM uemb_long", UEMB_SQL)
def src_kv_user_emb(spark, d):
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.to_kv_embeddings(_user_vectors(spark, d), skv.USER_EMB_PREFIX, "user_id"), path)
    e = skr.read_kv_embeddings(spark, path, skv.USER_EMB_PREFIX, "user_id")
    return _long(e, "user_id").select("user_id", "dim", F.col("value").cast("float").alias("value"))


@query("sink_kv_ttl", "SELECT 'uEmb' AS prefix, count(*) AS live FROM uemb", UEMB_SQL)
def sink_kv_ttl(spark, d):
    """User vectors written at the last rating time, item vectors two days
    earlier; read one hour after the last rating, only the user entries live."""
    path = scratch_dir(spark) + "/kv"
    t = _as_of(spark, d)
    ue = _user_vectors(spark, d)
    skv.write_kv(skv.to_kv_embeddings(ue, skv.USER_EMB_PREFIX, "user_id", as_of=t), path)
    skv.write_kv(skv.to_kv_embeddings(cv.item_emb(spark, d), skv.ITEM_EMB_PREFIX, "item_id", as_of=t - 2 * skv.DAY_SECONDS), path)
    read_at = t + 3600
    live = [skr.read_kv(spark, path, p, as_of=read_at).groupBy("prefix").agg(F.count(F.lit(1)).alias("live"))
            for p in (skv.USER_EMB_PREFIX, skv.ITEM_EMB_PREFIX)]
    return live[0].unionByName(live[1])


@query("sink_recs_csv",
       """SELECT user_id, item_id, round(score, 6) AS score FROM ranked WHERE rank <= 5""",
       *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def sink_recs_csv(spark, d):
    path = scratch_dir(spark) + "/recs"
    r, i = kept_views(spark, d)
    sk.write_recommendations(rk.recommend(r, i, cv.item_emb(spark, d), k=5, rounded=True), path)
    return spark.read.schema("user_id bigint, item_id bigint, score double").csv(path)


@query("sink_scored_pairs",
       f"SELECT user_id, item_id, rating, round(coalesce({sql_cos100('u_emb', 'i_emb')}, -1), 6) AS score FROM pairs",
       UEMB_SQL, PAIRS_SQL)
def sink_scored_pairs(spark, d):
    path = scratch_dir(spark) + "/pairs"
    r, i = kept_views(spark, d)
    ie = cv.item_emb(spark, d)
    sk.write_scored_pairs(rk.score_pairs(r, r, i, emb.user_embeddings(r, ie), ie), path)
    return spark.read.schema("user_id bigint, item_id bigint, rating double, score double").csv(path)


@query("sample_split_job",
       f"""SELECT part, count(*) AS n FROM (
             SELECT CASE WHEN {sql_uniform(['user_id', 'item_id'], 43)} < 0.8 THEN 'train' ELSE 'test' END AS part
             FROM user_feats WHERE {sql_uniform(['user_id', 'item_id'], 42)} < 0.1) x
           GROUP BY part""",
       *_FEATS)
def sample_split_job(spark, d):
    from reelsift.operators.samples import split_and_save

    s = training_samples(spark, d)
    tr, te = split_and_save(s, scratch_dir(spark), fraction=0.1, seed=42, by="random")
    rd = lambda p, name: spark.read.schema(s.schema).option("header", True).csv(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return rd(tr, "train").unionByName(rd(te, "test"))


@query("sample_split_job_time",
       f"""SELECT part, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM (
             SELECT ts, CASE WHEN ts <= (SELECT min(ts) FROM (SELECT ts, cume_dist() OVER (ORDER BY ts) AS cd FROM picked) c WHERE cd >= 0.8)
                             THEN 'train' ELSE 'test' END AS part FROM picked) x
           GROUP BY part""",
       *_FEATS, f"picked AS (SELECT * FROM user_feats WHERE {sql_uniform(['user_id', 'item_id'], 42)} < 0.1)")
def sample_split_job_time(spark, d):
    from reelsift.operators.samples import split_and_save

    s = training_samples(spark, d)
    tr, te = split_and_save(s, scratch_dir(spark), fraction=0.1, seed=42, by="time", relative_error=0.0)
    rd = lambda p, name: spark.read.schema(s.schema).option("header", True).csv(p).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).select(F.lit(name).alias("part"), "n", "first_ts", "last_ts")
    return rd(tr, "train").unionByName(rd(te, "test"))


# ---- projections --------------------------------------------------------------

@query("release_year", f"SELECT item_id, {sql_year('title')} AS release_year FROM items")
def release_year_q(spark, d):
    return cv.items(spark, d).select("item_id", release_year("title").alias("release_year"))


@query("release_year_strict", f"SELECT item_id, {sql_year('title', '0', '0')} AS release_year FROM items")
def release_year_strict(spark, d):
    return cv.items(spark, d).select("item_id", release_year("title", 0, 0).alias("release_year"))


@query("clean_title", f"SELECT item_id, CASE WHEN {_HAS_YEAR} THEN trim(substr({_T}, 1, length({_T}) - 6)) ELSE {_T} END AS title FROM items")
def clean_title_q(spark, d):
    return cv.items(spark, d).select("item_id", clean_title("title").alias("title"))


@query("genre_slots",
       "SELECT item_id, string_split(genres, '|')[1] AS g1, string_split(genres, '|')[2] AS g2, string_split(genres, '|')[3] AS g3 FROM items")
def genre_slots(spark, d):
    i = cv.items(spark, d)
    return i.select("item_id", *[genre_slot("genres", k).alias(f"g{k + 1}") for k in range(3)])


@query("genre_array",
       f"SELECT item_id, len({sql_genre_list('genres')}) AS genre_count, array_to_string({sql_genre_list('genres')}, '|') AS genre_text FROM items")
def genre_array_q(spark, d):
    g = genre_array("genres")
    return cv.items(spark, d).select("item_id", F.size(g).alias("genre_count"), F.array_join(g, "|").alias("genre_text"))


_SLOTS = ", ".join(f"user_rated_movie{i}" for i in range(1, 6))
_GSLOTS = ", ".join(f"user_genre{i}" for i in range(1, 6))


@query("user_recent_items", f"SELECT user_id, item_id, {_SLOTS} FROM user_feats", *_FEATS)
def user_recent_items(spark, d):
    return _user_feats(spark, d, 100).select("user_id", "item_id", *[f"user_rated_movie{i}" for i in range(1, 6)])


@query("user_genre_slots", f"SELECT user_id, item_id, {_GSLOTS} FROM user_feats", *_FEATS)
def user_genre_slots(spark, d):
    return _user_feats(spark, d, 100).select("user_id", "item_id", *[f"user_genre{i}" for i in range(1, 6)])


@query("fill_numeric", "SELECT item_id, round(coalesce(var_samp(rating), 0), 6) AS rating_var FROM ratings GROUP BY item_id")
def fill_numeric(spark, d):
    return itf.item_rating_variance(cv.ratings(spark, d)).select("item_id", "rating_var").na.fill(0)


@query("fill_string",
       "SELECT r.user_id, r.item_id, coalesce(i.genres, '') AS genres FROM ratings r LEFT JOIN items i ON r.item_id = i.item_id")
def fill_string(spark, d):
    r, i = views(spark, d)
    return r.join(i, "item_id", "left").select("user_id", "item_id", "genres").na.fill("")


@query("format_features",
       f"SELECT item_id, {sql_fmt2('avg(rating) * 1000')} AS avg_x1000, {sql_fmt2('avg(rating)')} AS avg_rating FROM ratings GROUP BY item_id")
def format_features(spark, d):
    g = cv.ratings(spark, d).groupBy("item_id").agg(F.avg("rating").alias("a"))
    return g.select("item_id", fmt2(F.col("a") * 1000).alias("avg_x1000"), fmt2("a").alias("avg_rating"))


@query("cast_ratings", "SELECT user_id, item_id, rating, ts FROM ratings")
def cast_ratings_q(spark, d):
    return cast_ratings(cv.ratings(spark, d))


# ---- joins ---------------------------------------------------------------------

@query("join_ratings_items",
       "SELECT r.user_id, r.item_id, r.rating, r.ts, i.title, i.genres FROM ratings r LEFT JOIN items i ON r.item_id = i.item_id")
def join_ratings_items(spark, d):
    r, i = views(spark, d)
    return r.join(i, "item_id", "left").select("user_id", "item_id", "rating", "ts", "title", "genres")


@query("join_item_stats",
       "SELECT user_id, item_id, movie_rating_count, movie_avg_rating, movie_rating_stddev FROM item_feats",
       LABELLED_SQL, ITEM_FEATURES_SQL)
def join_item_stats(spark, d):
    return _item_feats(spark, d).select("user_id", "item_id", "movie_rating_count", "movie_avg_rating", "movie_rating_stddev")


@query("join_links",
       "SELECT i.item_id, i.title, l.imdb_id, l.tmdb_id FROM items i LEFT JOIN links l ON i.item_id = l.item_id")
def join_links(spark, d):
    return cv.items(spark, d).join(cv.links(spark, d), "item_id", "left").select("item_id", "title", "imdb_id", "tmdb_id")


@query("join_known_emb", "SELECT e.item_id, len(e.emb) AS n_dims FROM item_emb e SEMI JOIN items i ON e.item_id = i.item_id")
def join_known_emb(spark, d):
    e = cv.item_emb(spark, d).join(cv.items(spark, d).select("item_id"), "item_id", "left_semi")
    return e.select("item_id", F.size("emb").alias("n_dims"))


@query("join_known_user_emb", "SELECT u.user_id, len(u.emb) AS n_dims FROM uemb u SEMI JOIN (SELECT user_id FROM ratings WHERE rating >= 3.5) k ON u.user_id = k.user_id", UEMB_SQL)
def join_known_user_emb(spark, d):
    """User vectors read from entries, attached to the users of a table (here: those who liked something)."""
    path = scratch_dir(spark) + "/kv"
    skv.write_kv(skv.to_kv_embeddings(_user_vectors(spark, d), skv.USER_EMB_PREFIX, "user_id"), path)
    known = cv.ratings(spark, d).where("rating >= 3.5").select("user_id").distinct()
    return skr.read_kv_embeddings(spark, path, skv.USER_EMB_PREFIX, "user_id").join(known, "user_id", "left_semi").select("user_id", F.size("emb").alias("n_dims"))


@query("join_known_ratings",
       "SELECT r.user_id, r.item_id, r.rating FROM ratings r JOIN items i ON r.item_id = i.item_id")
def join_known_ratings(spark, d):
    r, i = views(spark, d)
    return r.join(i.select("item_id"), "item_id").select("user_id", "item_id", "rating")


@query("job_files_to_recs", _fallback_sql(), *RECALL_CTES, UEMB_SQL, SCORED_SQL)
def job_files_to_recs(spark, d):
    """Ratings, items and two vector files (the second a later version of some ids) to everybody's recommendations."""
    from reelsift.plans.jobs import files_to_recommendations

    base, ie = scratch_dir(spark), cv.item_emb(spark, d)
    old = ie.withColumn("emb", F.when(F.col("item_id") % 2 == 0, F.reverse("emb")).otherwise(F.col("emb")))
    sk.write_embeddings(old, base + "/a", "item_id")
    sk.write_embeddings(ie.where(F.col("item_id") % 2 == 0), base + "/b", "item_id")
    recs = files_to_recommendations(spark, _ratings_csv(spark, d), _items_csv(spark, d), [base + "/a", base + "/b"], base + "/recs", rounded=True)
    return recs.select("user_id", "item_id", "score", "is_fallback", "rank")
