"""Scoring and ranking of candidates.

Scores of the embedding mode are cosine x 100 with the -1 sentinel for a
missing vector; ranks use the score, then item_id, so the order is total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.functions import cosine100, dot, round6, uniform, unit_vector
from reelsift.operators.embedding import user_embeddings, vector_bounds
from reelsift.operators.item_features import item_profile
from reelsift.operators.recall import (
    catalog_bounds, channel_bound, channel_table, listed_items, meet_users, recall, spread_users, user_channel_keys, with_seen,
)
from reelsift.plans.joins import MAX_BROADCAST_BYTES, broadcast_within, row_bytes
from reelsift.session import written

MISSING_SCORE = -1.0  # fixed value: sentinel score when a vector is missing
RECOMMENDATIONS = 5  # fixed value: recommendations per user
GENRE_WEIGHT = 0.7  # fixed value: content score weights
RATING_WEIGHT = 0.3
MAX_RATING = 5.0


def emb_score(a, b) -> Column:
    """R2: null-safe embedding score: cosine x 100, or -1 when it cannot be computed."""
    return F.coalesce(cosine100(a, b), F.lit(MISSING_SCORE))


def content_score(genres_a, genres_b, avg_rating_b) -> Column:
    """0.7 * shared / (n1 + n2) / 2 + 0.3 * avg_rating / 5 (both lists empty -> genre part 0)."""
    a, b = F.col(genres_a) if isinstance(genres_a, str) else genres_a, F.col(genres_b) if isinstance(genres_b, str) else genres_b
    shared = F.size(F.filter(a, lambda g: F.array_contains(b, g)))
    total = F.size(a) + F.size(b)
    genre_sim = F.when(total == 0, F.lit(0.0)).otherwise(shared / total / 2)
    r = F.col(avg_rating_b) if isinstance(avg_rating_b, str) else avg_rating_b
    return genre_sim * GENRE_WEIGHT + r / MAX_RATING * RATING_WEIGHT


def rank_within(df: DataFrame, key: str, score: str = "score", rank_col: str = "rank", rounded: bool = False) -> DataFrame:
    """Rank rows of each ``key`` by score desc, then item_id.

    ``rounded`` takes scores that agree to 6 places as ties, for comparisons
    with an engine whose sums differ in the last bits.
    """
    by = round6(score) if rounded else F.col(score)
    w = Window.partitionBy(key).orderBy(by.desc(), F.col("item_id").asc())
    return df.withColumn(rank_col, F.row_number().over(w))


def item_sides(items: DataFrame, ratings: DataFrame, item_emb: DataFrame, mode: str = "embedding") -> tuple[DataFrame, int]:
    """What ``rank_items`` needs of an item as (item_id, side), and the bytes of a row: its unit vector (embedding), its
    genres and average rating (content).  Broadcast when all of its bytes are within the limit."""
    if mode == "embedding":
        rows, width = vector_bounds(item_emb)
        per_row = row_bytes(width)
        return broadcast_within(item_emb.select("item_id", unit_vector("emb").alias("side")), rows, per_row), per_row
    n_items, _, chars = catalog_bounds(items)
    per_row = row_bytes(1, 2 * chars)
    return broadcast_within(item_profile(items, ratings).select("item_id", F.struct("genre_list", "average_rating").alias("side")), n_items, per_row), per_row


def rank_items(pairs: DataFrame, items: DataFrame, ratings: DataFrame, item_emb: DataFrame, mode: str = "embedding",
               rounded: bool = False) -> DataFrame:
    """Score each (user_id, history_item, item_id) candidate against the history item.

    embedding: cosine of the two item vectors (-1 when either is missing);
    content: genre overlap and the candidate's average rating.
    Pairs that come with their ``history_side`` and ``item_side`` (``recall`` with ``item_sides``) are scored in place,
    however many items there are.  Others look them up: broadcast when their bytes (rows and lengths from the items side,
    never the pairs) are within the limit, so the pairs keep their user partitioning for the per-user rank.
    """
    if "item_side" not in pairs.columns:
        sides, _ = item_sides(items, ratings, item_emb, mode)
        h = sides.select(F.col("item_id").alias("history_item"), F.col("side").alias("history_side"))
        pairs = pairs.join(h, "history_item", "left").join(sides.withColumnRenamed("side", "item_side"), "item_id", "left")
    if mode == "embedding":
        score = F.coalesce(unit_dot100(F.col("history_side"), F.col("item_side")), F.lit(MISSING_SCORE))
    else:
        empty = F.array().cast("array<string>")
        score = content_score(F.coalesce("history_side.genre_list", empty), F.coalesce("item_side.genre_list", empty), F.coalesce("item_side.average_rating", F.lit(0.0)))
    return rank_within(pairs.select("user_id", "history_item", "item_id", score.alias("score")), "user_id", rounded=rounded)


def rank_for_users(candidates: DataFrame, user_emb: DataFrame | None, item_emb: DataFrame | None, mode: str = "embedding",
                   rounded: bool = False) -> DataFrame:
    """Score (user_id, item_id) candidates for their user.

    embedding: cosine(user vector, item vector), -1 when missing;
    positional: n - i + 1 over the candidates in item_id order.
    """
    if mode == "embedding":
        scored = candidates.join(user_emb.withColumnRenamed("emb", "u_emb"), "user_id", "left").join(
            item_emb.select("item_id", F.col("emb").alias("i_emb")), "item_id", "left"
        )
        scored = scored.withColumn("score", emb_score("u_emb", "i_emb")).drop("u_emb", "i_emb")
    else:
        w = Window.partitionBy("user_id")
        pos = F.row_number().over(w.orderBy("item_id"))
        scored = candidates.withColumn("score", (F.count(F.lit(1)).over(w) - pos + 1).cast("double"))
    return rank_within(scored, "user_id", rounded=rounded)


def fallback_score(user="user_id", item="item_id", seed: int = 0) -> Column:
    """Deterministic stand-in for the reference's random [0, 100) score."""
    return uniform(user, item, seed=seed) * 100.0


def unit_dot100(a, b) -> Column:
    """Cosine x 100 of two pre-normalised vectors; null when either is missing
    (a zero vector normalises to null) or the sizes differ."""
    ok = a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b))
    return F.when(ok, dot(a, b) * 100.0)


def score_candidates(ratings: DataFrame, items: DataFrame, item_emb: DataFrame, user_emb: DataFrame,
                     history: str = "last") -> DataFrame:
    """(user_id, item_id, score, missing) for every recalled candidate, embedding mode.

    ``missing`` marks the -1 sentinel (a vector could not be used), so a
    genuine score of -1 is never mistaken for it.

    Item unit vectors ride on the small channel table (broadcast when its
    bound, 20 x genres + 200 rows, is within the limit), user unit vectors on
    the users' rows, which are written once and spread over partitions by the
    pairs that arise from them.  The candidate pairs are never shuffled,
    neither for their union nor for the per-user rank after it.
    """
    bounds = catalog_bounds(items)
    bound = channel_bound(bounds[1])
    channels = written(channel_table(item_profile(items, ratings)).select("key", "item_id"))
    few = item_emb.join(broadcast_within(channels.select("item_id").distinct(), bound), "item_id", "left_semi")
    vectors = written(few.select("item_id", unit_vector("emb").alias("i_unit")))
    lists = listed_items(channels).join(broadcast_within(vectors, *(b := vector_bounds(item_emb))[:1], row_bytes(b[1])), "item_id", "left")
    per_row = row_bytes(b[1], 2 * bounds[2])
    users = user_channel_keys(ratings, items, bounds=bounds, history=history)
    if history == "all":  # every rated item leaves the candidates
        users = with_seen(users, ratings, channels, bound)
    users = written(users.join(user_emb.select("user_id", unit_vector("emb").alias("u_unit")), "user_id", "left"))
    pairs = meet_users(spread_users(users), lists, bound, per_row)
    pairs = pairs.where(~F.array_contains("seen", F.col("item_id")) if history == "all" else F.col("item_id") != F.col("history_item"))
    cos = unit_dot100(F.col("u_unit"), F.col("i_unit"))
    scored = pairs.select("user_id", "item_id", cos.alias("cos")).select("user_id", "item_id", F.coalesce("cos", F.lit(MISSING_SCORE)).alias("score"), F.col("cos").isNull().alias("missing"))
    if not (_repeats(vectors, "item_id") or _repeats(users, "user_id")):
        return scored
    # an id with several vectors: the best score counts
    return scored.groupBy("user_id", "item_id").agg(F.max("score").alias("score"), F.max("missing").alias("missing"))


def _repeats(df: DataFrame, col: str) -> bool:
    rows, ids = df.where(F.col(col).isNotNull()).agg(F.count(F.lit(1)), F.count_distinct(col)).first()
    return rows > ids


def recommend(
    ratings: DataFrame,
    items: DataFrame,
    item_emb: DataFrame,
    k: int = RECOMMENDATIONS,
    mode: str = "embedding",
    fallback: bool = False,
    seed: int = 0,
    user_emb: DataFrame | None = None,
    dim: int | None = None,
    history: str = "last",
    rounded: bool = False,
) -> DataFrame:
    """Batch recommendations for every user: recall -> score -> top k [-> fallback -> re-sort].

    ``history``: "last" (the serving side's single history item) or "all".

    With ``fallback``, a missing-vector score (-1 sentinel) inside the top k is
    replaced by a deterministic uniform in [0, 100) and the k rows are
    re-ranked, as the serving side does after its cut.
    Output: user_id, item_id, score, rank (and is_fallback with fallback).
    """
    if mode == "embedding":
        if user_emb is None:
            user_emb = user_embeddings(ratings, item_emb, dim=dim)
        ranked = rank_within(score_candidates(ratings, items, item_emb, user_emb, history), "user_id", rounded=rounded)
    else:
        cands = recall(ratings, items, with_channels=False, history=history).select("user_id", "item_id")
        ranked = rank_for_users(cands, None, None, mode).withColumn("missing", F.lit(False))
    ranked = ranked.where(F.col("rank") <= k)
    if not fallback:
        return ranked.select("user_id", "item_id", "score", "rank")
    # only a genuinely missing score falls back (not a real cosine that happens to be -1)
    missing = F.col("missing")
    fixed = ranked.select(
        "user_id", "item_id",
        F.when(missing, fallback_score(seed=seed)).otherwise(F.col("score")).alias("score"),
        missing.alias("is_fallback"),
    )
    return rank_within(fixed, "user_id", rounded=rounded)


def banded_fallback(rating="rating", u: Column | None = None) -> Column:
    """A score inside the band of the (true) rating: lo + u * (hi - lo).

    Fixed bands: rating >= 4 -> (80, 90); [3, 4) -> (65, 80); (2, 3) -> (45, 60); <= 2 -> [0, 45).
    """
    r = F.col(rating) if isinstance(rating, str) else rating
    bands = [(r >= 4, 80.0, 90.0), ((r >= 3) & (r < 4), 65.0, 80.0), ((r > 2) & (r < 3), 45.0, 60.0), (r <= 2, 0.0, 45.0)]
    expr = None
    for cond, lo, hi in bands:
        val = F.lit(lo) + u * F.lit(hi - lo)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def pair_cosines(pairs: DataFrame, items: DataFrame, user_emb: DataFrame, item_emb: DataFrame) -> DataFrame:
    """(user_id, item_id, cosine) of pairs whose item is known; null where a vector cannot be used.

    Pairs go to their users without any vector, and item vectors within the broadcast bound then meet them in place, so no
    row travels with a vector.  Beyond the bound the pairs get the item vectors (floats) first, and travel with these.
    """
    rows, width = vector_bounds(item_emb)
    known = pairs.select("user_id", "item_id").join(broadcast_within(items.select("item_id"), catalog_bounds(items)[0]), "item_id", "left_semi")
    users, vectors = user_emb.withColumnRenamed("emb", "u_emb"), item_emb.select("item_id", F.col("emb").alias("i_emb"))
    per_row = row_bytes() + 4 * width
    small = rows * per_row <= MAX_BROADCAST_BYTES
    joined = known.join(users, "user_id", "left").join(F.broadcast(vectors), "item_id", "left") if small else known.join(vectors, "item_id", "left").join(users, "user_id", "left")
    return joined.select("user_id", "item_id", cosine100("u_emb", "i_emb").alias("cosine"))


def score_pairs(pairs: DataFrame, ratings: DataFrame, items: DataFrame, user_emb: DataFrame, item_emb: DataFrame,
                banded: bool = False, seed: int = 0) -> DataFrame:
    """R10 (J11 + R2) [+ R11]: score rated (user, item, rating) pairs whose user and item are known.

    Known users are those with any rating, known items those with an item row.
    With ``banded``, negative scores are replaced inside the rating's band and
    flagged ``is_fallback`` (the band uses the true rating: never evaluate on it).
    """
    # item vectors first: they are one side of known items, and the user vectors then ride through no item shuffle
    rows, width = vector_bounds(item_emb)
    known = items.select("item_id").join(item_emb.select("item_id", F.col("emb").alias("i_emb")), "item_id", "left")
    known = broadcast_within(known, rows + catalog_bounds(items)[0], row_bytes(width))
    scored = pairs.join(known, "item_id")
    if ratings is not pairs:  # pairs of the ratings themselves have known users only
        scored = scored.join(ratings.select("user_id").distinct(), "user_id", "left_semi")
    scored = scored.join(user_emb.withColumnRenamed("emb", "u_emb"), "user_id", "left")
    s = emb_score("u_emb", "i_emb")
    out = scored.select("user_id", "item_id", "rating", s.alias("score"))
    if not banded:
        return out
    neg = F.col("score") < 0
    return out.select(
        "user_id", "item_id", "rating",
        F.when(neg, banded_fallback("rating", uniform("user_id", "item_id", seed=seed))).otherwise(F.col("score")).alias("score"),
        neg.alias("is_fallback"),
    )


__all__ = [
    "banded_fallback", "content_score", "emb_score", "fallback_score", "item_sides", "pair_cosines", "rank_for_users", "rank_items",
    "rank_within", "recommend", "score_candidates", "score_pairs", "unit_dot100",
]
