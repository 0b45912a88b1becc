import math

from pyspark.sql import functions as F

from reelsift.operators import rank as rk
from reelsift.operators import recall as rc
from reelsift.operators.embedding import user_embeddings
from reelsift.sources import canonical as cv

SF = "/root/testdata/sf0.001"


def test_content_score_cases(spark):
    df = spark.createDataFrame(
        [([], [], 5.0), ([], ["A"], 0.0), (["A", "B"], ["A", "B"], 5.0), (["A"], ["B"], 2.5)],
        "a array<string>, b array<string>, r double",
    )
    got = [x.s for x in df.select(rk.content_score("a", "b", "r").alias("s")).collect()]
    assert math.isclose(got[0], 0.3) and math.isclose(got[1], 0.0)
    assert math.isclose(got[2], 0.7 * 2 / 4 / 2 + 0.3) and math.isclose(got[3], 0.15)


def test_banded_fallback_ranges(spark):
    df = spark.createDataFrame([(r, u) for r in (5.0, 4.0, 3.5, 3.0, 2.5, 2.0, 0.5) for u in (0.0, 0.5, 0.999)], "rating double, u double")
    for x in df.select("rating", rk.banded_fallback("rating", F.col("u")).alias("s")).collect():
        lo, hi = (80, 90) if x.rating >= 4 else (65, 80) if x.rating >= 3 else (45, 60) if x.rating > 2 else (0, 45)
        assert lo <= x.s < hi


def test_recommendations_invariants(spark):
    r, i, e = cv.ratings(spark, SF), cv.items(spark, SF), cv.item_emb(spark, SF)
    recs = rk.recommend(r, i, e, k=5).collect()
    hist = {x.user_id: x.item_id for x in r.groupBy("user_id").agg(F.max(F.struct("ts", "item_id"))["item_id"].alias("item_id")).collect()}
    by_user = {}
    for x in recs:
        assert x.item_id != hist[x.user_id]
        by_user.setdefault(x.user_id, []).append(x)
    assert len(by_user) == r.select("user_id").distinct().count()
    for rows in by_user.values():
        rows.sort(key=lambda z: z.rank)
        assert [z.rank for z in rows] == list(range(1, len(rows) + 1))
        assert all(a.score >= b.score - 1e-9 for a, b in zip(rows, rows[1:]))


def test_recall_channels_bounded(spark):
    r, i = cv.ratings(spark, SF), cv.items(spark, SF)
    from reelsift.operators.item_features import item_profile

    ch = rc.channel_table(item_profile(i, r)).groupBy("key").count().collect()
    assert all(x["count"] <= (100 if x.key.startswith("#") else 20) for x in ch)


def test_user_embedding_divides_by_all_ratings(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 1), (1, 11, 4.0, 2), (2, 12, 1.0, 1)], "user_id bigint, item_id bigint, rating double, ts bigint")
    e = spark.createDataFrame([(10, [1.0, 2.0]), (12, [4.0, 0.0])], "item_id bigint, emb array<float>")
    got = {x.user_id: x.emb for x in user_embeddings(r, e).collect()}
    assert got == {1: [0.5, 1.0], 2: [4.0, 0.0]}
    matched = {x.user_id: x.emb for x in user_embeddings(r, e, divisor="matched").collect()}
    assert matched[1] == [1.0, 2.0]


def test_recall_history_all_excludes_every_rated_item(spark):
    r, i = cv.ratings(spark, SF), cv.items(spark, SF)
    allh = rc.recall(r, i, history="all", with_channels=False)
    assert allh.join(r, ["user_id", "item_id"]).count() == 0
    last = rc.recall(r, i, with_channels=False).select("user_id", "item_id")
    # every user's genre set under "all" contains its last item's genres, so only rated items can disappear
    missing = last.join(allh.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    assert missing.join(r, ["user_id", "item_id"], "left_anti").count() == 0


def test_embedding_job_writes_vectors(spark, tmp_out):
    from reelsift.operators.embedding import embedding_job
    from reelsift.sources.files import read_embeddings

    iv, uv, _ = embedding_job(cv.ratings(spark, SF), out_dir=tmp_out)
    assert read_embeddings(spark, tmp_out + "/users", "user_id").count() == uv.count()
    assert read_embeddings(spark, tmp_out + "/items").count() == iv.count()


def test_fallback_only_for_missing_vectors(spark):
    r, i, e = cv.ratings(spark, SF), cv.items(spark, SF), cv.item_emb(spark, SF)
    ue = user_embeddings(r, e)
    ue = ue.select("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.col("emb")).alias("emb"))
    recs = rk.recommend(r, i, e, k=5, fallback=True, seed=1, user_emb=ue).collect()
    assert any(x.is_fallback for x in recs) and not all(x.is_fallback for x in recs)
    for x in recs:
        assert x.is_fallback == (x.user_id % 3 == 0)
        if x.is_fallback:
            assert 0.0 <= x.score < 100.0


def test_recommend_whole_history_never_recommends_rated_items(spark):
    r, i, e = cv.ratings(spark, SF), cv.items(spark, SF), cv.item_emb(spark, SF)
    recs = rk.recommend(r, i, e, k=5, history="all")
    assert recs.join(r, ["user_id", "item_id"]).count() == 0
    assert recs.groupBy("user_id").count().where("count > 5").count() == 0


def test_pairs_meet_item_vectors_in_place(spark):
    """Even where Spark would not broadcast by itself, only the narrow pairs are shuffled to their users."""
    from reelsift.operators.rank import pair_cosines

    rows = [(u, i, 1.0, 0) for u in range(4) for i in range(5)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")
    items = spark.createDataFrame([(i, "t", "g") for i in range(4)], "item_id long, title string, genres string")
    ie = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "item_id long, emb array<float>")
    ue = spark.createDataFrame([(u, [1.0, 0.0]) for u in range(3)], "user_id long, emb array<double>")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = pair_cosines(r, items, ue, ie)
        got = {(x.user_id, x.item_id): x.cosine for x in out.collect()}
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(got) == 16 and abs(got[0, 0] - 100) < 1e-9 and got[3, 0] is None and got[0, 3] is None
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1


def _small_catalog(spark):
    r = spark.createDataFrame([(u, 1 + (u + j) % 6, 1.0 + (u * j) % 5, j) for u in range(40) for j in range(3)] + [(None, 2, 3.0, 1)], "user_id long, item_id long, rating double, ts long")
    i = spark.createDataFrame([(n, f"t{n} ({1990 + n})", ("A|B", "B", "A|B|C", None, "C", "A|")[n - 1]) for n in range(1, 7)], "item_id long, title string, genres string")
    e = spark.createDataFrame([(n, [float(n), 1.0, -float(n % 2)]) for n in (1, 2, 3, 5)], "item_id long, emb array<float>")
    return r, i, e


def test_pairs_are_united_row_by_row_in_partitions_that_follow_them(spark, monkeypatch):
    """The users' rows are few bytes, but hundreds of pairs arise from each: their number sets the partitions, and no
    aggregate, sort or shuffle of the pairs unites what several channels found."""
    r, i, _ = _small_catalog(spark)
    monkeypatch.setattr(rc, "PAIR_ROWS", 1000)
    got = rc.recall(r, i)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    above = plan[: plan.index("BroadcastHashJoin")]
    assert "Aggregate" not in above and "Sort" not in above and "Exchange" not in above
    keys = rc.user_channel_keys(r, i).agg(F.sum(F.size("keys")), F.count("*")).first()
    assert got.rdd.getNumPartitions() == math.ceil((keys[0] * 20 + keys[1] * 200) / 1000) > 8
    users = {x.user_id: (x.history_item, set(x["keys"])) for x in rc.user_channel_keys(r, i).collect()}
    from reelsift.operators.item_features import item_profile

    want = {}
    for c in rc.channel_table(item_profile(i, r)).collect():
        for u, (h, keys) in users.items():
            if c.key in keys and c.item_id != h:
                want.setdefault((u, h, c.item_id), set()).add(c.channel)
    rows = got.collect()
    assert {(x.user_id, x.history_item, x.item_id): x.channels for x in rows} == {k: sorted(v) for k, v in want.items()} and len(rows) == len(want)


def test_items_are_looked_up_for_users_and_channel_items_not_for_pairs(spark):
    """Where no item table is broadcast too, the pairs of a recall meet none and give the scores of the lookup."""
    r, i, e = _small_catalog(spark)
    rows = lambda df: sorted((x.user_id is None, x.user_id or 0, x.item_id, round(x.score, 9), x["rank"]) for x in df.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("embedding", "content"):
            looked_up = rows(rk.rank_items(rc.recall(r, i, with_channels=False), i, r, e, mode, rounded=True))
            sides, per_row = rk.item_sides(i, r, e, mode)
            sides = sides.hint("shuffle_merge")  # an item table that is not broadcast
            ranked = rk.rank_items(rc.recall(r, i, with_channels=False, sides=sides, side_bytes=per_row), i, r, e, mode, rounded=True)
            plan = ranked._jdf.queryExecution().sparkPlan().toString()
            assert "SortMergeJoin" not in plan[: plan.index("BroadcastHashJoin")] and rows(ranked) == looked_up
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_of_several_vectors_of_an_item_the_best_score_counts(spark):
    r, i, e = _small_catalog(spark)
    users = spark.createDataFrame([(u, [1.0, 0.5, 0.0]) for u in range(40)], "user_id long, emb array<double>")
    twice = e.unionByName(e.select("item_id", F.transform("emb", lambda x: -x).alias("emb")))
    one = {(x.user_id, x.item_id): x.score for x in rk.score_candidates(r, i, e, users).where("not missing").collect()}
    two = rk.score_candidates(r, i, twice, users).where("not missing").collect()
    assert len(two) == len(one) and all(abs(x.score - abs(one[x.user_id, x.item_id])) < 1e-9 for x in two)


def test_only_ratings_with_a_vector_are_summed(spark):
    """Ratings without a vector are counted and do not pass through the vector aggregate as zeros."""
    rows = [(1, 10), (1, 11), (1, 12), (None, 10), (None, 11), (2, 11), (3, 13)]
    r = spark.createDataFrame([(u, i, 4.0, 1) for u, i in rows], "user_id long, item_id long, rating double, ts long")
    e = spark.createDataFrame([(10, [1.0, 2.0]), (12, [4.0, 0.0]), (13, None)], "item_id long, emb array<float>")
    out = user_embeddings(r, e)
    assert {x.user_id: x.emb for x in out.collect()} == {1: [5 / 3, 2 / 3], None: [0.5, 1.0], 2: None, 3: None}
    assert {x.user_id: x.emb for x in user_embeddings(r, e, dim=2, divisor="matched").collect()} == {1: [2.5, 1.0], None: [1.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Summarizer") if "Summarizer" in plan else plan.index("aggregate_metrics") :]
    assert below.index("Join Inner") < (below.index("Join LeftOuter") if "Join LeftOuter" in below else len(below))
