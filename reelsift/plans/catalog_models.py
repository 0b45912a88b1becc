"""Catalog: encoders, nearest neighbours, trained models, evaluation, sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelsift.functions import cosine100, dot
from reelsift.operators import cf, encode, evaluate, neighbors, products
from reelsift.operators import embedding as emb
from reelsift.operators import item2vec_blocks as i2v
from reelsift.operators import samples as smp
from reelsift.operators.item_features import item_profile
from reelsift.operators.lsh_join import lsh_neighbours
from reelsift.operators.recall import top_items
from reelsift.operators.user_features import last_item
from reelsift.plans.catalog_recall import PROFILE_SQL, UEMB_SQL, sql_cos100
from reelsift.plans.common import BLANKED_ITEMS_SQL, blanked_items, kept_views, sql_genre_pieces, sql_uniform
from reelsift.plans.registry import query
from reelsift.session import written
from reelsift.sources import canonical as cv

SEED = 42
W2V_PARTITIONS = 8  # models averaged an iteration; what is checked does not depend on it

# ---- encoders ---------------------------------------------------------------


@query("one_hot_items", "SELECT item_id, max(item_id) OVER () + 1 AS vec_size, item_id AS active_index FROM items")
def one_hot_items(spark, d):
    o = encode.one_hot(cv.items(spark, d), "item_id", "vec")
    return o.select(
        "item_id",
        encode.vector_size("vec").alias("vec_size"),
        F.get(encode.vector_active("vec"), 0).alias("active_index"),
    )


_GENRES_SQL = f"genres_long AS (SELECT item_id, unnest({sql_genre_pieces('genres')}) AS genre FROM ({BLANKED_ITEMS_SQL}) i)"
_GENRE_IDX_SQL = """genre_idx AS (
  SELECT genre, row_number() OVER (ORDER BY count(*) DESC, genre) - 1 AS genre_index FROM genres_long GROUP BY genre)"""


@query("genre_index_labels", "SELECT genre, genre_index FROM genre_idx", _GENRES_SQL, _GENRE_IDX_SQL)
def genre_index_labels(spark, d):
    model, g = encode.genre_indexer(blanked_items(spark, d))
    return model.transform(g).select("genre", F.col("genre_index").cast("bigint").alias("genre_index")).distinct()


@query("multi_hot_genres",
       """SELECT g.item_id, (SELECT count(*) FROM genre_idx) AS vec_size,
                 string_agg(CAST(x.genre_index AS VARCHAR), ',' ORDER BY x.genre_index) AS active
          FROM genres_long g JOIN genre_idx x ON g.genre = x.genre GROUP BY g.item_id""",
       _GENRES_SQL, _GENRE_IDX_SQL)
def multi_hot_genres(spark, d):
    m = encode.multi_hot(blanked_items(spark, d))
    act = F.array_join(F.transform("genre_indexes", lambda i: i.cast("string")), ",")
    return m.select("item_id", F.col("index_size").alias("vec_size"), act.alias("active"))


@query("multi_hot_spread",
       """SELECT g.item_id, (SELECT count(*) FROM genre_idx) AS vec_size,
                 string_agg(CAST(x.genre_index AS VARCHAR), ',' ORDER BY x.genre_index) AS active
          FROM genres_long g JOIN genre_idx x ON g.genre = x.genre GROUP BY g.item_id""",
       _GENRES_SQL, _GENRE_IDX_SQL)
def multi_hot_spread(spark, d):
    m = encode.multi_hot_spread(blanked_items(spark, d), head_labels=16)
    act = F.array_join(F.transform("genre_indexes", lambda i: i.cast("string")), ",")
    return m.select("item_id", F.col("index_size").alias("vec_size"), act.alias("active"))


@query("rated_item_index",
       """SELECT r.user_id, r.item_id, x.label_index FROM ratings r JOIN (
            SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) - 1 AS label_index FROM ratings GROUP BY item_id) x
          ON r.item_id = x.item_id""")
def rated_item_index(spark, d):
    r = written(cv.ratings(spark, d).select("user_id", "item_id", F.col("item_id").cast("string").alias("label")))
    index = written(encode.frequency_index(r, "label"))
    return encode.with_index(r, "label", index, head_labels=1000).select("user_id", "item_id", "label_index")


_STATS_SQL = "stats AS (SELECT item_id, count(*) AS rating_count, avg(rating) AS avg_rating, var_samp(rating) AS rating_var FROM ratings GROUP BY item_id)"
_SPLITS_SQL = """splits AS (
  SELECT list_distinct(quantile_disc(rating_count, [i / 100 for i in range(1, 100)])) AS qs FROM stats)"""


@query("quantile_buckets",
       "SELECT item_id, rating_count, CAST(len(list_filter(qs, lambda s: s <= rating_count)) AS DOUBLE) AS bucket FROM stats JOIN splits ON true",
       _STATS_SQL, _SPLITS_SQL)
def quantile_buckets(spark, d):
    st = written(cv.ratings(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("rating_count")))
    return encode.quantile_bucket(st, "rating_count", 100, "bucket").select("item_id", "rating_count", "bucket")


_MINMAX = """CASE WHEN max(avg_rating) OVER () = min(avg_rating) OVER () THEN 0.5
     ELSE (avg_rating - min(avg_rating) OVER ()) / (max(avg_rating) OVER () - min(avg_rating) OVER ()) END"""


@query("minmax_avg_rating", f"SELECT item_id, round(avg_rating, 6) AS avg_rating, round({_MINMAX}, 6) AS scaled FROM stats", _STATS_SQL)
def minmax_avg_rating(spark, d):
    st = cv.ratings(spark, d).groupBy("item_id").agg(F.avg("rating").alias("avg_rating"))
    return encode.minmax(st, "avg_rating", "scaled").select("item_id", "avg_rating", "scaled")


@query("rating_features",
       f"""SELECT item_id, rating_count, round(avg_rating, 6) AS avg_rating, round(rating_var, 6) AS rating_var,
                  CAST(len(list_filter(qs, lambda s: s <= rating_count)) AS DOUBLE) AS rating_count_bucket,
                  round({_MINMAX}, 6) AS scaled_avg_rating
           FROM stats JOIN splits ON true""",
       _STATS_SQL, _SPLITS_SQL)
def rating_features(spark, d):
    f = encode.rating_features(cv.ratings(spark, d))
    return f.select("item_id", "rating_count", "avg_rating", "rating_var", "rating_count_bucket", "scaled_avg_rating")


# ---- nearest neighbours -----------------------------------------------------

_SIM_SQL = f"""
sim AS (
  SELECT a.item_id AS seed_id, b.item_id, {sql_cos100('a.emb', 'b.emb')} AS score
  FROM item_emb a JOIN item_emb b ON a.item_id <> b.item_id)"""


@query("similar_items_exact",
       """SELECT seed_id, item_id, round(score, 6) AS score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY round(score, 6) DESC, item_id) AS rank FROM sim) x
          WHERE rank <= 20""",
       _SIM_SQL)
def similar_items_exact(spark, d):
    return neighbors.similar_items(spark, cv.item_emb(spark, d), 20, rounded=True)


_POOL_SQL = f"""
hist AS (SELECT user_id, arg_max(item_id, (ts, item_id)) AS history_item FROM ratings GROUP BY user_id),
pool AS (SELECT item_id FROM profile ORDER BY average_rating DESC, item_id LIMIT 10000),
seeds AS (SELECT h.user_id, e.emb FROM hist h JOIN item_emb e ON h.history_item = e.item_id),
pool_scores AS (
  SELECT s.user_id, p.item_id, coalesce({sql_cos100('s.emb', 'e.emb')}, -1) AS score
  FROM seeds s JOIN pool p ON true LEFT JOIN item_emb e ON p.item_id = e.item_id)"""


def _recall_by_embedding(spark, d, descending):
    r, i = kept_views(spark, d)
    ie = cv.item_emb(spark, d)
    pool = top_items(item_profile(i, r), 10000, "rating").select("item_id").join(ie, "item_id", "left")
    seeds = last_item(r).join(ie, "item_id").select(F.col("user_id").alias("seed_id"), F.col("emb").alias("vec"))
    out = neighbors.exact_top_k(spark, seeds, pool.select("item_id", F.col("emb").alias("vec")), 20, "cosine", descending, rounded=True)
    return out.select(F.col("seed_id").alias("user_id"), "item_id", "score", "rank")


@query("recall_by_embedding",
       """SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank FROM pool_scores) x
          WHERE rank <= 20""",
       PROFILE_SQL, _POOL_SQL)
def recall_by_embedding(spark, d):
    return _recall_by_embedding(spark, d, True)


@query("recall_by_embedding_asc",
       """SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6), item_id) AS rank FROM pool_scores) x
          WHERE rank <= 20""",
       PROFILE_SQL, _POOL_SQL)
def recall_by_embedding_asc(spark, d):
    return _recall_by_embedding(spark, d, False)


_KNN_SQL = """
knn AS (
  SELECT u.user_id, e.item_id,
         sqrt(list_sum(list_transform(list_zip(u.emb, CAST(e.emb AS DOUBLE[])), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance
  FROM uemb u JOIN item_emb e ON true)"""


@query("knn_exact",
       """SELECT user_id, item_id, round(distance, 6) AS distance, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(distance, 6), item_id) AS rank FROM knn) x
          WHERE rank <= 5""",
       UEMB_SQL, _KNN_SQL)
def knn_exact(spark, d):
    r = written(cv.ratings(spark, d))
    ie = cv.item_emb(spark, d)
    ue = emb.user_embeddings(r, ie, dim=emb.embedding_dim(ie))
    out = neighbors.exact_top_k(spark, ue.select(F.col("user_id").alias("seed_id"), F.col("emb").alias("vec")),
                                ie.select("item_id", F.col("emb").alias("vec")), 5, "euclidean", descending=False, rounded=True)
    return out.select(F.col("seed_id").alias("user_id"), "item_id", F.col("score").alias("distance"), "rank")


@query("lsh_buckets", "SELECT item_id, CAST(unnest([0, 1, 2]) AS BIGINT) AS table_idx, true AS is_projection FROM item_emb")
def lsh_buckets(spark, d):
    """Buckets, each compared with the projection of the item's vector on the model's hash directions."""
    ie = cv.item_emb(spark, d)
    model, _ = neighbors.lsh_model(ie, seed=SEED)
    direction = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in neighbors.lsh_directions(model, emb.embedding_dim(ie))])
    b = neighbors.lsh_buckets(ie, seed=SEED).join(ie, "item_id")
    at = dot(F.get(direction, F.col("table_idx")), F.col("emb").cast("array<double>")) / neighbors.LSH_BUCKET_LENGTH
    # next to a bucket's edge the recovered direction's last digits may tip it over
    ok = (F.col("bucket") == F.floor(at)) | (F.abs(at - F.round(at)) < 1e-4)
    return b.select("item_id", "table_idx", ok.alias("is_projection"))


@query("ann_lsh", "SELECT true AS has_k, true AS exact_distances, true AS within_all")
def ann_lsh(spark, d):
    """The approximate neighbours, held against exact distances of all items."""
    ie = cv.item_emb(spark, d)
    key = neighbors.centroid(ie)
    center = F.array(*[F.lit(float(x)) for x in key])
    gap = F.zip_with(F.col("emb").cast("array<double>"), center, lambda x, y: (x - y) * (x - y))
    exact = ie.select("item_id", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda a, x: a + x)).alias("true_distance"))
    found = neighbors.ann(ie, key, 5, seed=SEED).join(exact, "item_id", "left")
    return found.agg(
        (F.count(F.lit(1)) == 5).alias("has_k"),
        F.bool_and(F.abs(F.col("distance") - F.col("true_distance")) < 1e-6).alias("exact_distances"),
        F.bool_and(F.col("true_distance").isNotNull()).alias("within_all"),
    )


@query("lsh_join",
       """SELECT seed_id, rank, true AS is_cosine, true AS not_above_exact, true AS recall_90 FROM (
            SELECT seed_id, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, item_id) AS rank FROM sim) x WHERE rank <= 20""",
       _SIM_SQL)
def lsh_join(spark, d):
    """Twenty neighbours of every item by the LSH join, each held against the exact list: the pair's cosine, no better
    than the exact neighbour of its rank, and nine in ten of all exact neighbours found."""
    ie = cv.item_emb(spark, d)
    found = written(lsh_neighbours(ie, 20, tables=4, bits=4, probes=6, seed=SEED))
    exact = written(neighbors.similar_items(spark, ie, 20, rounded=True))
    vec = lambda name: ie.select(F.col("item_id").alias(name), F.col("emb").cast("array<double>").alias(f"{name}_vec"))
    hit = exact.select("seed_id", "item_id", F.lit(1).alias("hit"))
    recall = found.join(hit, ["seed_id", "item_id"]).agg(F.count(F.lit(1)).alias("found")).join(exact.agg(F.count(F.lit(1)).alias("all")))  # one row each
    rows = found.join(vec("seed_id"), "seed_id").join(vec("item_id"), "item_id")
    rows = rows.join(exact.select("seed_id", "rank", F.col("score").alias("best")), ["seed_id", "rank"])
    near = F.abs(cosine100("seed_id_vec", "item_id_vec") - F.col("score")) < 1e-6
    return rows.join(F.broadcast(recall)).select(
        "seed_id", F.col("rank").cast("bigint").alias("rank"), near.alias("is_cosine"), (F.col("score") <= F.col("best") + 1e-6).alias("not_above_exact"), (F.col("found") >= 0.9 * F.col("all")).alias("recall_90"))


# ---- item2vec ---------------------------------------------------------------

@query("item2vec_vocab",
       "SELECT item_id, CAST(10 AS BIGINT) AS dim FROM ratings WHERE rating >= 3.5 GROUP BY item_id HAVING count(*) >= 5")
def item2vec_vocab(spark, d):
    model = emb.train_item2vec(emb.item_sequences(written(cv.ratings(spark, d))), seed=SEED, partitions=W2V_PARTITIONS)
    return emb.item_vectors(model).select("item_id", F.size("emb").alias("dim"))


@query("synonyms_w2v", "SELECT CAST(unnest(range(1, 21)) AS BIGINT) AS rank, true AS is_cosine, true AS is_best")
def synonyms_w2v(spark, d):
    r = written(cv.ratings(spark, d))
    model = emb.train_item2vec(emb.item_sequences(r), seed=SEED, partitions=W2V_PARTITIONS)
    # seed item: the most liked item (ties: smallest id), taken from the data
    top = smp.filter_positive(r).groupBy("item_id").count().orderBy(F.col("count").desc(), "item_id").first()["item_id"]
    found = emb.synonyms(model, top, 20).withColumn("rank", F.row_number().over(Window.orderBy(F.col("similarity").desc())))
    vectors = written(emb.item_vectors(model).select("item_id", F.col("emb").cast("array<double>").alias("emb")))
    best = neighbors.similar_items(spark, vectors, 20, vectors.where(F.col("item_id") == int(top))).select(F.col("rank").alias("r"), (F.col("score") / 100).alias("s"))
    seed = vectors.where(F.col("item_id") == int(top)).select(F.col("emb").alias("seed_emb"))
    out = found.join(vectors, "item_id").join(best, F.col("rank") == F.col("r")).crossJoin(F.broadcast(seed))  # one seed row
    close = lambda x: F.abs(F.col("similarity") - x) < 1e-4
    return out.select("rank", close(cosine100("emb", "seed_emb") / 100).alias("is_cosine"), close(F.col("s")).alias("is_best"))


_COOCCUR = """liked AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos FROM ratings WHERE rating >= 3.5),
often AS (SELECT item_id FROM liked GROUP BY item_id HAVING count(*) >= 5),
placed AS (SELECT user_id, pos // 1000 AS chunk, item_id, row_number() OVER (PARTITION BY user_id, pos // 1000 ORDER BY pos) AS at FROM liked JOIN often USING (item_id)),
cooccur AS (SELECT least(x.item_id, y.item_id) AS item_a, greatest(x.item_id, y.item_id) AS item_b, CAST(sum(6 - (y.at - x.at)) AS BIGINT) AS n
  FROM placed x JOIN placed y ON x.user_id = y.user_id AND x.chunk = y.chunk AND y.at > x.at AND y.at <= x.at + 5 GROUP BY 1, 2)"""


@query("item2vec_pairs", "SELECT item_a, item_b, n FROM cooccur", _COOCCUR)
def item2vec_pairs(spark, d):
    return i2v.cooccurrence(emb.item_sequences(cv.ratings(spark, d)))


# the vectors' products follow the counts: a pair's mean product lies above that of items that never met
@query("item2vec_blocks",
       """SELECT item_id, CAST(sum(n) AS BIGINT) AS n, CAST(10 AS BIGINT) AS dim, true AS pairs_above_strangers
          FROM (SELECT item_a AS item_id, n FROM cooccur UNION ALL SELECT item_b, n FROM cooccur) x GROUP BY item_id""", _COOCCUR)
def item2vec_blocks(spark, d):
    pairs = written(i2v.cooccurrence(emb.item_sequences(written(cv.ratings(spark, d)))))
    v = written(i2v.train_item2vec_blocks(pairs, seed=SEED))
    gap = i2v.product_gap(v, pairs)
    return v.join(F.broadcast(gap)).select("item_id", "n", F.size("emb").alias("dim"), (F.col("met") > F.col("unmet")).alias("pairs_above_strangers"))  # one row of means


@query("embedding_job", "SELECT DISTINCT user_id, CAST(10 AS BIGINT) AS dim FROM ratings")
def embedding_job(spark, d):
    _, uv, _ = emb.embedding_job(cv.ratings(spark, d), seed=SEED, partitions=W2V_PARTITIONS)
    return uv.select("user_id", F.size("emb").alias("dim"))


# ---- ALS and evaluation -----------------------------------------------------

_SPLIT_SQL = f"""
parts AS (SELECT *, {sql_uniform(['user_id', 'item_id'], SEED + 1)} < 0.8 AS is_train FROM ratings),
train AS (SELECT * FROM parts WHERE is_train),
test AS (SELECT * FROM parts WHERE NOT is_train)"""


def _als(spark, d):
    train, test = smp.random_split(written(cv.ratings(spark, d)), 0.8, SEED)
    return cf.train_als(train, seed=SEED), train, test


@query("als_factors",
       """SELECT 'user' AS kind, user_id AS id, CAST(10 AS BIGINT) AS rank FROM train GROUP BY user_id
          UNION ALL SELECT 'item', item_id, CAST(10 AS BIGINT) FROM train GROUP BY item_id""",
       _SPLIT_SQL)
def als_factors(spark, d):
    model, _, _ = _als(spark, d)
    return cf.factors(model).select("kind", "id", F.size("features").alias("rank"))


@query("als_predictions",
       """SELECT user_id, item_id, true AS is_product FROM test
          WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""",
       _SPLIT_SQL)
def als_predictions(spark, d):
    model, _, test = _als(spark, d)
    f = cf.factors(model)
    u = f.where("kind = 'user'").select(F.col("id").alias("user_id"), F.col("features").alias("uf"))
    i = f.where("kind = 'item'").select(F.col("id").alias("item_id"), F.col("features").alias("itf"))
    p = cf.predict(model, test).join(u, "user_id").join(i, "item_id")
    product = dot(F.col("uf").cast("array<double>"), F.col("itf").cast("array<double>"))
    return p.select("user_id", "item_id", (F.abs(F.col("prediction") - product) < 1e-3).alias("is_product"))


@query("als_user_recs",
       "SELECT user_id, least(10, (SELECT count(DISTINCT item_id) FROM train)) AS n_recs FROM train GROUP BY user_id",
       _SPLIT_SQL)
def als_user_recs(spark, d):
    model, _, _ = _als(spark, d)
    return cf.user_recs(model).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_recs"))


@query("als_item_recs",
       "SELECT item_id, least(10, (SELECT count(DISTINCT user_id) FROM train)) AS n_recs FROM train GROUP BY item_id",
       _SPLIT_SQL)
def als_item_recs(spark, d):
    model, _, _ = _als(spark, d)
    return cf.item_recs(model).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_recs"))


def _recs_against_library(model, of):
    """Each place of each list, held against the product of all users and items with Spark ML's own scores: the same score,
    and the product of the two factors."""
    other = "item" if of == "user" else "user"
    mine = (cf.user_recs if of == "user" else cf.item_recs)(model)
    theirs = cf.library_recs(model, of).select(f"{of}_id", "rank", F.col("score").alias("their_score"))
    f = cf.factors(model)
    vec = lambda kind: f.where(F.col("kind") == kind).select(F.col("id").alias(f"{kind}_id"), F.col("features").cast("array<double>").alias(f"{kind}_vec"))
    both = mine.join(theirs, [f"{of}_id", "rank"], "full").join(vec(of), f"{of}_id", "left").join(vec(other), f"{other}_id", "left")
    close = lambda x: F.coalesce(F.abs(F.col("score") - x) < 1e-4, F.lit(False))
    return both.select(f"{of}_id", F.col("rank").cast("bigint").alias("rank"), close(F.col("their_score")).alias("same_score"), close(dot("user_vec", "item_vec")).alias("is_product"))


@query("als_user_recs_values",
       """SELECT user_id, unnest(range(1, least(10, (SELECT count(DISTINCT item_id) FROM train)) + 1)) AS rank, true AS same_score, true AS is_product
          FROM train GROUP BY user_id""",
       _SPLIT_SQL)
def als_user_recs_values(spark, d):
    return _recs_against_library(_als(spark, d)[0], "user")


@query("als_item_recs_values",
       """SELECT item_id, unnest(range(1, least(10, (SELECT count(DISTINCT user_id) FROM train)) + 1)) AS rank, true AS same_score, true AS is_product
          FROM train GROUP BY item_id""",
       _SPLIT_SQL)
def als_item_recs_values(spark, d):
    return _recs_against_library(_als(spark, d)[0], "item")


# Inner products of the tables' own vectors: a user's last item's vector against all items, checked value by value.
_PRODUCTS_SQL = """
last_items AS (SELECT user_id, arg_max(item_id, (ts, item_id)) AS item_id FROM ratings GROUP BY user_id),
pulled AS (SELECT item_id, list_transform(CAST(emb AS DOUBLE[]), lambda x: x * (1 + item_id % 7)) AS v FROM item_emb),
products AS (
  SELECT l.user_id, p.item_id, list_sum(list_transform(list_zip(CAST(e.emb AS DOUBLE[]), p.v), lambda z: z[1] * z[2])) AS score
  FROM last_items l JOIN item_emb e ON l.item_id = e.item_id JOIN pulled p ON true)"""


@query("top_products",
       """SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM products) x
          WHERE rank <= 10""",
       _PRODUCTS_SQL)
def top_products(spark, d):
    """The exact search on vectors of very different lengths (item vectors times 1 to 7)."""
    ie = cv.item_emb(spark, d)
    users = last_item(cv.ratings(spark, d)).join(ie, "item_id").select(F.col("user_id").alias("seed_id"), F.col("emb").alias("vec"))
    pulled = F.transform(F.col("emb").cast("array<double>"), lambda x: x * (1 + F.col("item_id") % 7))
    found = products.best_products(users, ie.select("item_id", pulled.alias("vec")), 10)
    return found.select(F.col("seed_id").alias("user_id"), "item_id", "score", "rank")


@query("subset_ids", "SELECT DISTINCT user_id FROM ratings ORDER BY user_id LIMIT 3")
def subset_ids(spark, d):
    return cf.subset_ids(cv.ratings(spark, d), "user_id", 3)


@query("als_user_subset",
       """SELECT user_id, least(10, (SELECT count(DISTINCT item_id) FROM train)) AS n_recs
          FROM (SELECT DISTINCT user_id FROM train ORDER BY user_id LIMIT 3) s""",
       _SPLIT_SQL)
def als_user_subset(spark, d):
    model, train, _ = _als(spark, d)
    recs = cf.user_subset_recs(model, cf.subset_ids(train, "user_id", 3))
    return recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_recs"))


@query("als_item_subset",
       """SELECT item_id, least(10, (SELECT count(DISTINCT user_id) FROM train)) AS n_recs
          FROM (SELECT DISTINCT item_id FROM train ORDER BY item_id LIMIT 3) s""",
       _SPLIT_SQL)
def als_item_subset(spark, d):
    model, train, _ = _als(spark, d)
    recs = cf.item_subset_recs(model, cf.subset_ids(train, "item_id", 3))
    return recs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_recs"))


_PRED_SQL = """
predictions AS (
  SELECT user_id, item_id, rating, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label,
         round(((user_id * 31 + item_id * 17) % 100) / 100.0 + rating / 10, 3) AS p
  FROM ratings)"""


def predictions_view(spark, d):
    """Fixed prediction table for the exact metric checks (label, p, prediction)."""
    r = cv.ratings(spark, d)
    p = F.round(((F.col("user_id") * 31 + F.col("item_id") * 17) % 100) / 100.0 + F.col("rating") / 10, 3)
    return r.select("user_id", "item_id", "rating", F.when(F.col("rating") >= 3.5, 1).otherwise(0).alias("label"), p.alias("p"))


@query("rmse", "SELECT round(sqrt(avg((rating - p) * (rating - p))), 6) AS rmse FROM predictions", _PRED_SQL)
def rmse(spark, d):
    return evaluate.rmse(predictions_view(spark, d), "rating", "p")


_AUC_SQL = """
per AS (SELECT p AS s, sum(label) AS tp_n, sum(1 - label) AS fp_n FROM predictions GROUP BY p),
cum AS (SELECT s, sum(tp_n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(fp_n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(tp_n) OVER () AS P, sum(fp_n) OVER () AS N FROM per),
pts AS (SELECT s, fp / N AS fpr, tp / P AS tpr, tp / (tp + fp) AS prec FROM cum),
steps AS (SELECT fpr - coalesce(lag(fpr) OVER (ORDER BY s DESC), 0) AS dx,
                 tpr + coalesce(lag(tpr) OVER (ORDER BY s DESC), 0) AS roc_y2,
                 tpr - coalesce(lag(tpr) OVER (ORDER BY s DESC), 0) AS dr,
                 prec + coalesce(lag(prec) OVER (ORDER BY s DESC), first_value(prec) OVER (ORDER BY s DESC)) AS pr_y2
          FROM pts)"""


@query("auc_metrics", "SELECT round(sum(dx * roc_y2 / 2), 6) AS auc_roc, round(sum(dr * pr_y2 / 2), 6) AS auc_pr FROM steps",
       _PRED_SQL, _AUC_SQL)
def auc_metrics(spark, d):
    return evaluate.auc(predictions_view(spark, d), "label", "p")


@query("cv_folds",
       f"SELECT CAST(floor({sql_uniform(['user_id', 'item_id'], 7)} * 10) AS BIGINT) AS fold, count(*) AS n FROM ratings GROUP BY 1")
def cv_folds(spark, d):
    return cf.with_folds(cv.ratings(spark, d)).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def _scored_sql(folds: int) -> str:
    """Ratings of each fold whose user and item occur in another fold: what a fold's model can predict."""
    fold = f"CAST(floor({sql_uniform(['user_id', 'item_id'], 7)} * {folds}) AS BIGINT)"
    return f"""
folded AS (SELECT user_id, item_id, {fold} AS fold FROM ratings),
scored AS (
  SELECT fold, count(*) AS n FROM (
    SELECT fold, count(*) OVER (PARTITION BY user_id) - count(*) OVER (PARTITION BY user_id, fold) AS u,
           count(*) OVER (PARTITION BY item_id) - count(*) OVER (PARTITION BY item_id, fold) AS i FROM folded) x
  WHERE u > 0 AND i > 0 GROUP BY fold)"""


def _fold_rows(metrics):
    good = (F.col("rmse") > 0) & (F.col("rmse") < 4.5)  # the error of a rating of 0.5 to 5
    return metrics.select("reg_param", F.col("fold").cast("bigint").alias("fold"), "n", good.alias("in_scale"))


@query("als_cv", "SELECT reg_param, fold, n, true AS in_scale, true AS as_by_itself FROM scored, (VALUES (CAST(0.01 AS DOUBLE)), (0.1)) AS g(reg_param)", _scored_sql(3))
def als_cv(spark, d):
    """Each fold of each grid point, the average of each and the best one's fit on all ratings; the reference's own grid
    point is held against fitting the first fold by itself."""
    r = written(cv.ratings(spark, d))
    m = cf.cv_fold_metrics(r, regs=(0.01, 0.1), folds=3, seed=SEED)
    best, average = cf.best_of_grid(r, m, regs=(0.01, 0.1), seed=SEED)
    whole = best.model.rank == 10 and all(0 < x < 4.5 for x in average)  # the average error of each grid point, the best one's fit on all ratings
    alone = cf.fold_rmse(r, 0, 3, seed=SEED)
    compared = (F.col("reg_param") == 0.01) & (F.col("fold") == 0)
    # the two start from other random factors
    near = F.when(compared, F.abs(F.col("rmse") - F.lit(alone)) < 0.1 * alone).otherwise(True)
    rows = _fold_rows(m).withColumn("in_scale", F.col("in_scale") & F.lit(whole))
    return rows.join(m.select("reg_param", F.col("fold").cast("bigint").alias("fold"), near.alias("as_by_itself")), ["reg_param", "fold"])


@query("als_cv_10", "SELECT CAST(0.01 AS DOUBLE) AS reg_param, fold, n, true AS in_scale FROM scored", _scored_sql(10))
def als_cv_10(spark, d):
    """The reference's ten folds, each with the number of its ratings that its model could predict."""
    return _fold_rows(cf.cv_fold_metrics(written(cv.ratings(spark, d)), folds=10, seed=SEED))


# ---- sampling and splitting ---------------------------------------------------

@query("sample_10pct", f"SELECT user_id, item_id FROM ratings WHERE {sql_uniform(['user_id', 'item_id'], SEED)} < 0.1")
def sample_10pct(spark, d):
    return smp.sample_rows(cv.ratings(spark, d), 0.1, SEED).select("user_id", "item_id")


@query("split_random", "SELECT user_id, item_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM parts", _SPLIT_SQL)
def split_random(spark, d):
    tr, te = smp.random_split(cv.ratings(spark, d), 0.8, SEED)
    return tr.select("user_id", "item_id", F.lit("train").alias("part")).unionByName(
        te.select("user_id", "item_id", F.lit("test").alias("part")))


_TSPLIT_SQL = """
point AS (SELECT min(ts) AS split_ts FROM (SELECT ts, cume_dist() OVER (ORDER BY ts) AS cd FROM ratings) x WHERE cd >= 0.8)"""


@query("split_by_time",
       "SELECT user_id, item_id, CASE WHEN ts <= split_ts THEN 'train' ELSE 'test' END AS part FROM ratings JOIN point ON true",
       _TSPLIT_SQL)
def split_by_time(spark, d):
    tr, te, _ = smp.split_by_time(written(cv.ratings(spark, d)), 0.8, 0.0)
    return tr.select("user_id", "item_id", F.lit("train").alias("part")).unionByName(
        te.select("user_id", "item_id", F.lit("test").alias("part")))


@query("split_by_time_approx", "SELECT true AS whole, true AS ordered, true AS within_error")
def split_by_time_approx(spark, d):
    """The default split point (a sketch of error 0.05): complete, in time order, its share of training rows near 0.8."""
    r = written(cv.ratings(spark, d))
    tr, te, _ = smp.split_by_time(r)
    a, b = tr.agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("hi")), te.agg(F.count(F.lit(1)).alias("m"), F.min("ts").alias("lo"))
    n, m, hi, lo = (a.crossJoin(b)).select("n", "m", "hi", "lo").first()  # one row each
    ties = r.where(F.col("ts") == hi).count()  # rows of the split's own time all go to training
    share = n / (n + m)
    return spark.createDataFrame([(n + m == r.count(), hi < lo, 0.75 <= share <= 0.85 + ties / (n + m))], "whole boolean, ordered boolean, within_error boolean")
