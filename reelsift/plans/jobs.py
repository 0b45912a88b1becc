"""End-to-end jobs: the reference's entry points as compositions of operators.

Each job takes DataFrames and output folders (no hard-coded paths) and
returns what it wrote or computed.  Where one intermediate feeds several
writes, it is checkpointed once to the shared checkpoint folder: the lineage
is cut, the writes do not recompute it, and a lost executor does not send
the job back to the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.operators import cf, evaluate, samples
from reelsift.operators import embedding as emb
from reelsift.operators.item_features import latest_item_features
from reelsift.operators.rank import recommend, score_pairs
from reelsift.operators.training import build_samples
from reelsift.operators.user_features import latest_user_features
from reelsift.session import checkpoint_base, written
from reelsift.sinks import files as sk
from reelsift.sinks import kv as skv
from reelsift.sources import files as src


def feature_job(ratings: DataFrame, items: DataFrame, out_dir: str, by: str = "random", seed: int = 42,
                as_of: int | None = None, ttl: int | None = None) -> dict:
    """Labels -> item features -> user features -> sampled train/test CSV -> user and item feature-store entries."""
    checkpoint_base(ratings.sparkSession)
    table = build_samples(ratings, items).checkpoint(eager=True)
    train, test = samples.split_and_save(table, f"{out_dir}/samples", fraction=0.1, seed=seed, by=by)
    kv = f"{out_dir}/kv"
    skv.write_kv(skv.user_feature_kv(latest_user_features(table), as_of, ttl), kv)
    skv.write_kv(skv.item_feature_kv(latest_item_features(table), as_of, ttl), kv)
    return {"train": train, "test": test, "kv": kv, "samples": table}


def recommendation_job(ratings: DataFrame, items: DataFrame, item_emb: DataFrame, out_path: str, k: int = 5,
                       fallback: bool = True, seed: int = 0) -> str:
    """Recommendations for every user (recall -> score -> top k -> fallback) written as user,item,score lines."""
    return sk.write_recommendations(recommend(ratings, items, item_emb, k=k, fallback=fallback, seed=seed), out_path)


def files_to_recommendations(spark: SparkSession, ratings_path: str, items_path: str, item_emb_paths: list[str], out_path: str | None = None,
                             k: int = 5, fallback: bool = True, seed: int = 0, rounded: bool = False) -> DataFrame:
    """Strict file loads -> recommendations for every user [-> lines].

    Later vector files win; lines that the strict loaders refuse are skipped.
    The ratings are parsed once and kept in the shared checkpoint folder.
    """
    ratings = written(src.load_ratings_strict(spark, ratings_path).withColumn("rating", F.col("rating").cast("double")))
    items = written(src.load_items_strict(spark, items_path))
    year = F.when(F.col("release_year") != 0, F.concat(F.lit(" ("), F.col("release_year").cast("string"), F.lit(")"))).otherwise(F.lit(""))
    items = items.select("item_id", F.concat("title", year).alias("title"), "genres")
    item_emb = written(src.read_embeddings_multi(spark, item_emb_paths))
    recs = written(recommend(ratings, items, item_emb, k=k, fallback=fallback, seed=seed, rounded=rounded, dim=emb.embedding_dim(item_emb)))
    if out_path is not None:
        sk.write_recommendations(recs, out_path)
    return recs


def scoring_job(pairs: DataFrame, ratings: DataFrame, items: DataFrame, item_emb: DataFrame, out_path: str,
                user_emb: DataFrame | None = None, seed: int = 0) -> str:
    """Hold-out pairs scored by user/item vector cosine, banded fallback for negative scores, written as CSV."""
    if user_emb is None:
        user_emb = emb.user_embeddings(ratings, item_emb)
    return sk.write_scored_pairs(score_pairs(pairs, ratings, items, user_emb, item_emb, banded=True, seed=seed), out_path)


def cf_job(ratings: DataFrame, seed: int = 42, top: int = cf.ALS_TOP, folds: int = cf.CV_FOLDS, cross_validate: bool = True) -> dict:
    """80/20 split -> ALS -> predictions (cold start dropped) -> RMSE -> top lists -> k-fold CV on the split's test part."""
    train, test = samples.random_split(ratings, 0.8, seed)
    fit = cf.train_als(train, seed=seed)
    predictions = cf.predict(fit, test)
    out = {
        "model": fit,
        "predictions": predictions,
        "rmse": evaluate.rmse(predictions, "rating", "prediction").first()["rmse"],
        "user_recs": cf.user_recs(fit, top),
        "item_recs": cf.item_recs(fit, top),
        "user_subset_recs": cf.user_subset_recs(fit, cf.subset_ids(train, "user_id"), top),
        "item_subset_recs": cf.item_subset_recs(fit, cf.subset_ids(train, "item_id"), top),
    }
    if cross_validate:
        _, metrics = cf.cross_validate_als(test, folds=folds, seed=seed)
        out["cv_avg_rmse"] = metrics
    return out


def embedding_job(ratings: DataFrame, out_dir: str | None = None, seed: int = 42, partitions: int = 8) -> dict:
    """Liked-item sequences -> item2vec in ``partitions`` tasks, averaged each iteration -> item and user vectors
    [-> text files]."""
    iv, uv, model = emb.embedding_job(ratings, seed=seed, out_dir=out_dir, partitions=partitions)
    return {"item_emb": iv, "user_emb": uv, "model": model}
