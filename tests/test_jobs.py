import math

from reelsift.plans import jobs
from reelsift.sources import canonical as cv
from reelsift.sources import kv as skr

SF = "/root/testdata/sf0.001"


def test_feature_job(spark, tmp_out):
    r, i = cv.ratings(spark, SF), cv.items(spark, SF)
    out = jobs.feature_job(r, i, tmp_out, by="time")
    table = out["samples"]
    n_train = spark.read.option("header", True).csv(out["train"]).count()
    n_test = spark.read.option("header", True).csv(out["test"]).count()
    assert 0 < n_train + n_test < table.count()
    assert skr.read_kv(spark, out["kv"], "uf").count() == table.select("user_id").distinct().count()
    assert skr.read_kv(spark, out["kv"], "mf").count() == table.select("item_id").distinct().count()


def test_recommendation_and_scoring_jobs(spark, tmp_out):
    r, i, e = cv.ratings(spark, SF), cv.items(spark, SF), cv.item_emb(spark, SF)
    recs = spark.read.schema("user_id bigint, item_id bigint, score double").csv(jobs.recommendation_job(r, i, e, tmp_out + "/recs"))
    assert recs.count() == 5 * r.select("user_id").distinct().count()
    scored = spark.read.schema("user_id bigint, item_id bigint, rating double, score double").csv(
        jobs.scoring_job(r, r, i, e, tmp_out + "/pairs"))
    assert scored.count() == r.join(i.select("item_id"), "item_id", "left_semi").count()


def test_cf_job(spark):
    out = jobs.cf_job(cv.ratings(spark, SF), folds=3)
    assert math.isfinite(out["rmse"]) and out["rmse"] > 0
    assert out["user_recs"].groupBy("user_id").count().where("count > 10").count() == 0
    assert len(out["cv_avg_rmse"]) == 1


def test_embedding_job_trains_in_several_tasks(spark, monkeypatch):
    from reelsift.operators import embedding
    from reelsift.plans import jobs

    train, seen = embedding.train_item2vec, []
    monkeypatch.setattr(embedding, "train_item2vec", lambda *a, **k: (seen.append(k), train(*a, **k))[1])
    ratings = spark.createDataFrame([(u, i, 5.0, u * 100 + i) for u in range(30) for i in range(20)], "user_id long, item_id long, rating double, ts long")
    for partitions, options in ((8, {}), (3, {"partitions": 3})):
        assert jobs.embedding_job(ratings, **options)["user_emb"].count() == 30
        assert seen.pop()["partitions"] == partitions
