import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reelsift.operators import evaluate, neighbors
from reelsift.operators import samples as smp
from reelsift.sources import canonical as cv

SF = "/root/testdata/sf0.001"


def test_auc_matches_library(spark):
    rng = np.random.default_rng(1)
    rows = [(int(l), float(round(s, 2))) for l, s in zip(rng.integers(0, 2, 400), rng.random(400))]
    rows += [(1, 0.5), (0, 0.5), (1, 0.5)]  # tied scores
    df = spark.createDataFrame(rows, "label int, p double")
    mine = evaluate.auc(df, "label", "p").collect()[0]
    vec = df.select(F.col("label").cast("double").alias("label"), F.array(1 - F.col("p"), F.col("p")).alias("a"))
    from pyspark.ml.functions import array_to_vector

    vec = vec.select("label", array_to_vector("a").alias("rawPrediction"))
    for metric, got in (("areaUnderROC", mine.auc_roc), ("areaUnderPR", mine.auc_pr)):
        ref = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(vec)
        assert math.isclose(got, ref, rel_tol=1e-9), (metric, got, ref)


def test_rmse_matches_library(spark):
    df = spark.createDataFrame([(3.0, 2.5), (4.0, 4.0), (1.0, 2.0)], "rating double, prediction double")
    ref = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(df)
    assert math.isclose(evaluate.rmse(df).collect()[0].rmse, ref)


def test_exact_top_k_matches_brute_force_and_chunks(spark):
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(60, 4))
    items = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(60)], "item_id bigint, emb array<double>")
    one = neighbors.similar_items(spark, items, 3).collect()
    cands = items.select("item_id", F.col("emb").alias("vec"))
    seeds = items.select(F.col("item_id").alias("seed_id"), F.col("emb").alias("vec"))
    chunked = neighbors.exact_top_k(spark, seeds, cands, 3, "cosine", True, exclude_self=True, block_rows=7, part_rows=5).collect()
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -np.inf)
    for got in (one, chunked):
        by = {}
        for r in got:
            by.setdefault(r.seed_id, []).append((r.rank, r.item_id))
        for s, lst in by.items():
            assert [i for _, i in sorted(lst)] == list(np.argsort(-sims[s], kind="stable")[:3])


def test_lsh_ann_returns_k(spark):
    e = cv.item_emb(spark, SF)
    res = neighbors.ann(e, neighbors.centroid(e), 5).collect()
    assert len(res) == 5 and all(r.distance >= 0 for r in res)
    exact = neighbors.exact_top_k(spark, spark.createDataFrame([(0, neighbors.centroid(e).toArray().tolist())], "seed_id bigint, vec array<double>"),
                                  e.select("item_id", F.col("emb").alias("vec")), 5, "euclidean", descending=False).collect()
    assert min(r.score for r in exact) <= min(r.distance for r in res) + 1e-6


def test_splits_are_complete_and_disjoint(spark):
    r = cv.ratings(spark, SF)
    tr, te = smp.random_split(r, 0.8, 3)
    n, a, b = r.count(), tr.count(), te.count()
    assert a + b == n and tr.join(te, ["user_id", "item_id"]).count() == 0 and 0.7 < a / n < 0.9
    ttr, tte, point = smp.split_by_time(r, 0.8, 0.0)
    assert ttr.count() + tte.count() == n and ttr.agg(F.max("ts")).first()[0] == point
    ts = sorted(x.ts for x in r.select("ts").collect())
    assert point == ts[math.ceil(0.8 * n) - 1]
    _, _, approx = smp.split_by_time(r, 0.8, 0.05)
    assert abs(ts.index(approx) / n - 0.8) <= 0.06


def test_vector_helpers(spark):
    df = spark.createDataFrame([(Vectors.dense([0.2, 0.8]),)], ["probability"])
    assert df.select(evaluate.probability_of_positive("probability").alias("p")).first().p == 0.8


def test_running_totals_ranges_match_single_range(spark):
    from reelsift.operators.cumulative import running_totals

    rng = np.random.default_rng(3)
    rows = [(float(v), int(a), int(b)) for v, a, b in zip(rng.permutation(500) / 7.0, rng.integers(0, 5, 500), rng.integers(0, 5, 500))]
    df = spark.createDataFrame(rows, "v double, a bigint, b bigint")
    for desc in (False, True):
        one = sorted(tuple(r) for r in running_totals(df, "v", ["a", "b"], desc).collect())
        many = sorted(tuple(r) for r in running_totals(df, "v", ["a", "b"], desc, rows_per_range=37).collect())
        assert one == many
        ordered = sorted(rows, key=lambda r: -r[0] if desc else r[0])
        assert max(x[3] for x in one) == sum(r[1] for r in ordered)


def test_auc_and_time_split_with_many_ranges(spark):
    rng = np.random.default_rng(11)
    rows = [(int(l), float(round(s, 3))) for l, s in zip(rng.integers(0, 2, 3000), rng.random(3000))]
    df = spark.createDataFrame(rows, "label int, p double")
    a = evaluate.auc(df).collect()[0]
    b = evaluate.auc(df, rows_per_range=50).collect()[0]
    assert math.isclose(a.auc_roc, b.auc_roc, rel_tol=1e-12) and math.isclose(a.auc_pr, b.auc_pr, rel_tol=1e-12)
    r = cv.ratings(spark, SF)
    ts = sorted(x.ts for x in r.select("ts").collect())
    want = ts[math.ceil(0.8 * len(ts)) - 1]
    assert smp.time_split_point(r, 0.8, 0.0).first()[0] == want
    assert smp.time_split_point(r, 0.8, 0.0, rows_per_range=20).first()[0] == want


def test_split_and_save_both_ways(spark, tmp_out):
    r = cv.ratings(spark, SF)
    for by in ("random", "time"):
        tr, te = smp.split_and_save(r, f"{tmp_out}/{by}", fraction=0.5, seed=1, by=by)
        a = spark.read.schema(r.schema).option("header", True).csv(tr)
        b = spark.read.schema(r.schema).option("header", True).csv(te)
        sample = smp.sample_rows(r, 0.5, 1)
        assert a.count() + b.count() == sample.count() and a.join(b, ["user_id", "item_id"]).count() == 0
        if by == "time":
            assert a.agg(F.max("ts")).first()[0] < b.agg(F.min("ts")).first()[0]


def test_als_reindexes_ids_beyond_int_range(spark):
    from reelsift.operators import cf

    big = 3_000_000_000
    r = cv.ratings(spark, SF).select((F.col("user_id") + big).alias("user_id"), (F.col("item_id") + big).alias("item_id"), "rating", "ts")
    with pytest.raises(Exception):  # out of the range ALS takes: the caller must ask for new numbers
        cf.train_als(r, seed=1)
    fit = cf.train_als(r, seed=1, reindex=True)
    assert fit.user_index is not None and fit.item_index is not None
    f = cf.factors(fit)
    assert f.where("kind = 'user'").count() == r.select("user_id").distinct().count()
    assert f.agg(F.min("id")).first()[0] >= big
    recs = cf.user_recs(fit, 3)
    assert recs.agg(F.min("item_id")).first()[0] >= big and recs.groupBy("user_id").count().where("count <> 3").count() == 0
    p = cf.predict(fit, r.limit(50))
    assert p.count() == 50 and p.agg(F.min("user_id")).first()[0] >= big
    idx = cf.dense_index(r, "user_id", "user_idx").orderBy("user_id").collect()
    assert [x.user_idx for x in idx] == list(range(len(idx)))


def test_auc_all_positive_or_all_negative_is_undefined_not_an_error(spark):
    for label in (0, 1):
        df = spark.createDataFrame([(label, 0.1), (label, 0.7), (label, 0.7)], "label int, p double")
        row = evaluate.auc(df).collect()[0]
        assert row.auc_roc is None
    pos = spark.createDataFrame([(1, 0.1), (1, 0.7)], "label int, p double")
    assert math.isclose(evaluate.auc(pos).collect()[0].auc_pr, 1.0)  # precision is 1 everywhere


def test_native_sampling_and_split(spark):
    r = cv.ratings(spark, SF)
    n = r.count()
    s = smp.sample_rows(r, 0.5, 3, method="native").count()
    assert 0.35 * n < s < 0.65 * n
    tr, te = smp.random_split(r, 0.8, 3, method="native")
    assert tr.count() + te.count() == n and tr.join(te, ["user_id", "item_id"]).count() == 0


def test_exact_quantile_buckets_match_library(spark):
    from pyspark.ml.feature import QuantileDiscretizer

    from reelsift.operators import encode

    st = cv.ratings(spark, SF).groupBy("item_id").agg(F.count(F.lit(1)).alias("c"))
    for nb in (4, 10, 100):
        lib = QuantileDiscretizer(inputCol="c", outputCol="b", numBuckets=nb, relativeError=0.0).fit(st).getSplits()
        assert encode.exact_quantile_splits(st, "c", nb) == lib


def _top(spark, seeds, cands, **kw):
    from reelsift.operators import neighbors

    s = spark.createDataFrame(seeds, "seed_id bigint, vec array<double>")
    c = spark.createDataFrame(cands, "item_id bigint, vec array<double>")
    return sorted(tuple(r) for r in neighbors.exact_top_k(spark, s, c, **kw).collect())


@pytest.mark.parametrize("metric, descending", [("cosine", True), ("cosine", False), ("euclidean", False)])
def test_exact_top_k_with_missing_and_mixed_vectors(spark, metric, descending):
    rng = np.random.default_rng(5)
    cands = [(i, None if i % 3 == 0 else [0.0, 0.0] if i == 4 else list(map(float, rng.integers(-3, 4, 3 if i % 7 == 0 else 2)))) for i in range(40)]
    seeds = [(100 + i, list(map(float, rng.integers(-3, 4, 3 if i % 4 == 0 else 2)))) for i in range(9)] + [(200, None)]
    want = []
    for sid, v in seeds:
        if v is None:
            continue
        scored = []
        for cid, c in cands:
            ok = c is not None and len(c) == len(v)
            if metric == "cosine":
                den = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in c)) if ok else 0.0
                scored.append((sum(x * y for x, y in zip(v, c)) / den * 100 if den else -1.0, cid))
            elif ok:
                scored.append((math.dist(v, c), cid))
        scored.sort(key=lambda t: (-round(t[0], 6) if descending else round(t[0], 6), t[1]))
        want += [(sid, cid, rank + 1) for rank, (_, cid) in enumerate(scored[:5])]
    for blocks, parts in ((100, 100), (2, 100), (7, 3), (1, 1)):
        got = _top(spark, seeds, cands, k=5, metric=metric, descending=descending, block_rows=blocks, part_rows=parts, rounded=True)
        assert sorted((s, i, r) for s, i, _, r in got) == sorted(want)


def test_exact_top_k_without_any_candidate_vector(spark):
    cands = [(i, None) for i in range(8)]
    for blocks in (100, 2):
        got = _top(spark, [(1, [1.0, 2.0])], cands, k=3, metric="cosine", block_rows=blocks)
        assert got == [(1, 0, -1.0, 1), (1, 1, -1.0, 2), (1, 2, -1.0, 3)]
        assert _top(spark, [(1, [1.0, 2.0])], cands, k=3, metric="euclidean", descending=False, block_rows=blocks) == []
    assert _top(spark, [(1, [1.0])], [], k=3) == [] == _top(spark, [], cands, k=3)


def test_ranks_use_the_raw_score(spark):
    from reelsift.operators.rank import rank_within

    df = spark.createDataFrame([(1, 10, 0.50000001), (1, 9, 0.50000002), (1, 8, 0.1)], "user_id bigint, item_id bigint, score double")
    assert [r.item_id for r in rank_within(df, "user_id").orderBy("rank").collect()] == [9, 10, 8]
    assert [r.item_id for r in rank_within(df, "user_id", rounded=True).orderBy("rank").collect()] == [9, 10, 8]
    swapped = df.withColumn("score", F.when(F.col("item_id") == 10, 0.50000003).otherwise(F.col("score")))
    assert [r.item_id for r in rank_within(swapped, "user_id").orderBy("rank").collect()] == [10, 9, 8]


def test_item2vec_does_not_depend_on_the_layout(spark):
    from reelsift.operators import embedding as emb

    seqs = emb.item_sequences(cv.ratings(spark, SF))
    a = {r.item_id: r.emb for r in emb.item_vectors(emb.train_item2vec(seqs.coalesce(1), iterations=1, seed=3)).collect()}
    b = {r.item_id: r.emb for r in emb.item_vectors(emb.train_item2vec(seqs.repartition(5), iterations=1, seed=3)).collect()}
    assert a == b and len(a) > 10


def test_blank_genres_are_a_genre_and_null_ones_no_row(spark):
    from reelsift.operators import encode

    items = spark.createDataFrame([(1, "A|B"), (2, ""), (3, None), (4, "B|B|"), (300_000, "A")], "item_id bigint, genres string")
    got = {r.item_id: r for r in encode.multi_hot(items).collect()}
    labels = list(encode.genre_indexer(items)[0].labels)
    assert set(got) == {1, 2, 4, 300_000} and set(labels) == {"A", "B", ""}
    assert list(got[2].genre_indexes) == [labels.index("")] and list(got[4].genre_indexes) == [labels.index("B")]
    assert got[1].vector.size == 3 and sorted(got[1].vector.indices) == sorted([labels.index("A"), labels.index("B")])


def test_genre_index_does_not_depend_on_id_size(spark):
    from reelsift.operators.recall import genre_index

    items = spark.createDataFrame([(1, "A|B"), (250_000, "A"), (9_000_000_000, "A|A")], "item_id bigint, genres string")
    got = sorted(tuple(r) for r in genre_index(items).collect())
    assert got == [("A", 1, 3), ("A", 250_000, 3), ("A", 9_000_000_000, 3), ("B", 1, 1)]


def test_cross_validation_blocks_hold_part_of_one_fold(spark, monkeypatch):
    """No block of the joint fit holds more than about BLOCK_RATINGS ratings, and none mixes folds."""
    from reelsift.operators import cf

    r = cv.ratings(spark, SF)
    whole = {x.fold: x.n for x in cf.cv_fold_metrics(r, folds=4).collect()}
    made, make = [], cf.als_estimator
    monkeypatch.setattr(cf, "als_estimator", lambda *a, **k: made.append(make(*a, **k)) or made[-1])
    monkeypatch.setattr(cf, "BLOCK_RATINGS", 500)
    small = cf.cv_fold_metrics(r, folds=4).collect()
    blocks = made[0].getNumUserBlocks()
    assert blocks == made[0].getNumItemBlocks() and blocks % 4 == 0 and blocks >= 4 * (r.count() * 3 / 4) / 500
    assert {x.fold: x.n for x in small} == whole and all(0 < x.rmse < 4.5 for x in small)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_exact_top_k_in_rounds_has_the_same_rows(spark, monkeypatch, kind):
    """Many seeds meet the blocks round by round, each of bounded copies."""
    rng = np.random.default_rng(3)
    cast = f"cast(vec as array<{kind}>) as vec"
    seeds = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))], "seed_id bigint, vec array<double>").selectExpr("seed_id", cast)
    cands = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 4)))], "item_id bigint, vec array<double>").selectExpr("item_id", cast)
    rows = lambda **kw: sorted((r.seed_id, r["rank"], r.item_id, r.score) for r in neighbors.exact_top_k(spark, seeds, cands, 3, "euclidean", False, **kw).collect())
    want = rows()
    made, write = [], neighbors.written
    monkeypatch.setattr(neighbors, "written", lambda df: made.append(df.columns) or write(df))
    monkeypatch.setattr(neighbors, "WIDER", 1)
    monkeypatch.setattr(neighbors, "ROUND_COPIES", 120)  # two blocks a round
    got = rows(block_rows=18, part_rows=25)
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want])
    assert len(want) == 180 and len([c for c in made if "score" in c]) == 3
