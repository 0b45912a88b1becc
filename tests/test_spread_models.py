"""Vocabularies that stay tables: the frequency index and its join, item2vec by blocks, channel lists on a grid."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from reelsift.operators import encode
from reelsift.operators import item2vec_blocks as i2v
from reelsift.operators import rank as rk
from reelsift.operators import recall as rc
from reelsift.plans import joins
from reelsift.sources import canonical as cv

SF = "/root/testdata/sf0.001"


def _labels(spark, rows=3000, seed=1):
    rng = random.Random(seed)
    values = ["hot"] * (rows // 3) + [f"v{rng.randrange(60)}" for _ in range(rows)] + ["tie-b", "tie-a", "tie-c"] * 7 + [None] * 5 + [""]
    rng.shuffle(values)
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, label string")


@pytest.mark.parametrize("rows_per_partition", [7, 500_000])
def test_frequency_index_equals_string_indexer(spark, rows_per_partition):
    df = _labels(spark)
    got = {r.label: r.label_index for r in encode.frequency_index(df, "label", rows_per_partition=rows_per_partition).collect()}
    want = StringIndexer(inputCol="label", outputCol="x", stringOrderType="frequencyDesc", handleInvalid="skip").fit(df).labels
    assert got == {v: i for i, v in enumerate(want)}


@pytest.mark.parametrize("head", [0, 1, 5, 10_000])
def test_index_joins_back_whole(spark, head):
    df = _labels(spark)
    index = encode.frequency_index(df, "label")
    number = {r.label: r.label_index for r in index.collect()}
    unknown = spark.createDataFrame([(-1, "never seen")], "id bigint, label string")
    got = encode.with_index(df.unionByName(unknown), "label", index, head_labels=head).collect()
    assert len(got) == df.count() + 1
    assert all(r.label_index == number.get(r.label) for r in got)


def test_frequency_index_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, label string")
    index = encode.frequency_index(none, "label")
    assert index.collect() == []
    assert encode.with_index(_labels(spark, 10), "label", index).where("label_index is not null").count() == 0


def test_multi_hot_spread_has_the_rows_of_multi_hot(spark):
    items = cv.items(spark, SF)
    want = {r.item_id: (list(r.genre_indexes), r.index_size) for r in encode.multi_hot(items).collect()}
    for head in (3, 10_000):
        got = {r.item_id: ([int(x) for x in r.genre_indexes], r.index_size) for r in encode.multi_hot_spread(items, head).collect()}
        assert got == want


def _sequences(spark, lists):
    rows = [(u, p, x) for u, items in enumerate(lists) for p, x in enumerate(items)]
    return spark.createDataFrame(rows, "user_id bigint, pos bigint, item_id bigint")


def test_cooccurrence_equals_brute_force(spark):
    rng = random.Random(3)
    lists = [[rng.randrange(12) for _ in range(rng.randrange(0, 23))] for _ in range(30)] + [[99], [7, None, 7]]
    seen = {}
    for items in lists:
        for x in items:
            seen[x] = seen.get(x, 0) + 1
    want = {}
    for items in lists:
        for at in range(0, len(items), 8):
            kept = [x for x in items[at : at + 8] if x is not None and seen[x] >= 5]
            for i, x in enumerate(kept):
                for d, y in enumerate(kept[i + 1 : i + 4], 1):
                    k = (min(x, y), max(x, y))
                    want[k] = want.get(k, 0) + 4 - d
    got = {(r.item_a, r.item_b): r.n for r in i2v.cooccurrence(_sequences(spark, lists), window=3, max_len=8).collect()}
    assert got == want


def _groups(spark, groups=4, size=10, users=240, seed=5):
    rng = random.Random(seed)
    return _sequences(spark, [[g * 100 + rng.randrange(size) for _ in range(14)] for u in range(users) for g in [u % groups]])


def _vectors(df):
    return {r.item_id: (r.n, tuple(r.emb), tuple(r.context)) for r in df.collect()}


@pytest.mark.parametrize("block_items", [14, 4096])
def test_planted_groups_are_recovered(spark, block_items):
    pairs = i2v.cooccurrence(_groups(spark))
    got = _vectors(i2v.train_item2vec_blocks(pairs, block_items=block_items, epochs=4, passes=8))
    ids = sorted(got)
    assert len(ids) == 40
    e = np.array([got[i][1] for i in ids], dtype=float)
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    cos = e @ e.T - 2 * np.eye(len(ids))
    for i, row in zip(ids, cos):
        nearest = [ids[j] for j in np.argsort(-row)[:9]]
        assert all(j // 100 == i // 100 for j in nearest), (i, nearest)


def test_vectors_do_not_depend_on_layout_or_cluster(spark):
    pairs = i2v.cooccurrence(_groups(spark, users=60))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        one = _vectors(i2v.train_item2vec_blocks(pairs.coalesce(1), block_items=9, epochs=1))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        two = _vectors(i2v.train_item2vec_blocks(pairs.repartition(7), block_items=9, epochs=1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert one == two and len(one) == 40


def test_products_reach_the_known_optimum():
    """With enough dimensions the products of skip-gram with k drawn contexts go to log(n_ab * all_p / (n_a * p_b)) - log k."""
    rng = np.random.default_rng(0)
    size, k = 6, 3
    n = rng.integers(20, 400, (size, size))
    n = n + n.T
    of, p = n.sum(axis=1), np.round(n.sum(axis=1) ** 0.75 * 1024).astype(np.int64)
    a, b = (x.ravel() for x in np.indices((size, size)))
    u, v = rng.normal(0, 0.1, (size, 12)), rng.normal(0, 0.1, (size, 12))
    i2v.train_cell(u, v, np.zeros(size), np.zeros(size), a, b, n[a, b], of, p, int(p.sum()), rng, negative=k, passes=6000, rate=0.1)
    want = np.log(n * p.sum() / (of[:, None] * p[None, :])) - math.log(k)
    assert np.abs(u @ v.T - want).max() < 0.35
    assert np.corrcoef((u @ v.T).ravel(), want.ravel())[0, 1] > 0.97


def test_no_pairs_and_single_items(spark):
    none = i2v.cooccurrence(_sequences(spark, [[1], [2], []]))
    assert none.collect() == []
    out = i2v.train_item2vec_blocks(none)
    assert out.columns == ["item_id", "n", "emb", "context"] and out.collect() == []
    alone = i2v.train_item2vec_blocks(i2v.cooccurrence(_sequences(spark, [[5] * 6])), epochs=1).collect()
    assert [r.item_id for r in alone] == [5] and all(math.isfinite(x) for x in alone[0].emb)


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("history", ["last", "all"])
def test_recall_beyond_the_broadcast_bound_has_equal_rows(spark, monkeypatch, history):
    r, i, e = cv.ratings(spark, SF), cv.items(spark, SF), cv.item_emb(spark, SF)
    recalled, scored = _rows(rc.recall(r, i, history=history)), _rows(rk.recommend(r, i, e, k=5, history=history, rounded=True).select("user_id", "item_id", "rank"))
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "PIECE_ROWS", 30)
    assert _rows(rc.recall(r, i, history=history)) == recalled
    assert _rows(rk.recommend(r, i, e, k=5, history=history, rounded=True).select("user_id", "item_id", "rank")) == scored


def test_grid_leaves_no_place_with_all_rows_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    many = spark.range(4000).select(F.col("id").alias("user_id"), F.when(F.col("id") % 4 == 3, None).otherwise(F.lit("k")).alias("key"))
    lists = spark.range(90).select(F.lit("k").alias("key"), F.col("id").alias("item_id"))
    got = joins.meet_lists(many, lists, "key", "user_id", "item_id", F.lit(90), 90, piece_rows=30, salts=16)
    assert got.columns == ["key", "user_id", "item_id"] and got.count() == 3000 * 90 and got.distinct().count() == 3000 * 90
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_piece" in plan
    per = many.where("key is not null").groupBy(F.pmod(F.xxhash64("user_id"), F.lit(16)).alias("s")).count().agg(F.max("count")).first()[0]
    assert per < 3000 / 16 * 1.5


def test_rounds_do_not_grow_with_the_items():
    """Blocks grow with the vocabulary until a task's bounds: rounds times items, not the square of the items."""
    assert i2v.block_count(20_000, 2_000_000) == 5 and i2v.block_count(0, 0) == 1
    assert i2v.block_count(200_000, 20_000_000) == i2v.block_count(1_200_000, 140_000_000) == 24
    assert i2v.block_count(40_000_000, 5_000_000_000) == 100  # a block's items
    assert i2v.block_count(1_000_000, 40_000_000_000) == 100  # a cell's counts


def test_item2vec_has_every_frequent_item_without_the_drivers_vocabulary(spark, monkeypatch):
    """Items alone in their sequences have a vector too, and Spark ML's Word2Vec, whose vectors pass the driver, is not called."""
    from pyspark.ml import feature

    from reelsift.operators import embedding as emb

    def refuse(*a, **k):
        raise AssertionError("Word2Vec")

    monkeypatch.setattr(feature.Word2Vec, "fit", refuse)
    lists = [[1 + (u + i) % 3 for i in range(4)] for u in range(6)] + [[50]] * 5 + [[60]] * 4
    model = emb.train_item2vec(_sequences(spark, lists), partitions=4, iterations=2)
    got = {r.item_id: r.emb for r in emb.item_vectors(model).collect()}
    assert sorted(got) == [1, 2, 3, 50] and all(len(v) == 10 and any(v) for v in got.values())
    assert [r.item_id for r in emb.synonyms(model, 1, 2).collect()][0] in (2, 3, 50)


def test_rounds_move_a_few_rows_a_block_and_leave_only_the_last_state(spark, monkeypatch):
    """A block travels as rows of many items, and a round's table goes when the next is written."""
    import os

    made, write = [], i2v.written_at
    monkeypatch.setattr(i2v, "written_at", lambda *a: made.append(write(*a)) or made[-1])
    rows = _vectors(i2v.train_item2vec_blocks(i2v.cooccurrence(_groups(spark)), block_items=14, epochs=2))
    blocks = i2v.block_count(40, 0, 14)
    assert len(rows) == 40 and blocks == 3 and len(made) == 2 * blocks
    paths = [p.removeprefix("file:") for _, p in made]
    assert [os.path.exists(p) for p in paths] == [False] * (len(made) - 1) + [True]
    assert made[-1][0].count() == 2 * blocks


def test_larger_blocks_take_larger_steps(monkeypatch):
    """Steps of a block are as many as its items are met, not one for each batch of pairs."""
    steps, step = [], i2v._adagrad
    monkeypatch.setattr(i2v, "_adagrad", lambda vec, *a: steps.append(vec.shape[1]) or step(vec, *a))
    rng = np.random.default_rng(0)
    for size, pairs, want in ((100, 2000, 4), (4096, 8192, 2), (8192, 8192, 1)):
        a, b = np.divmod(rng.choice(size * size, pairs, replace=False), size)
        u, v = (rng.normal(0, 0.1, (size, 10)).astype(np.float32) for _ in range(2))
        of = np.full(size, 7)
        steps.clear()
        i2v.train_cell(u, v, np.zeros(size), np.zeros(size), a, b, np.ones(pairs, np.int64), of, of, int(of.sum()), rng, passes=1)
        assert steps == [size] * 2 * want and np.isfinite(u).all() and np.isfinite(v).all()


def test_drawn_rows_are_dealt_in_proportion():
    own = np.array([0, 1, 10, 100, 889])
    for seed in range(20):
        got = np.bincount(i2v._dealt(own, 500, np.random.default_rng(seed)), minlength=5)
        assert got.sum() == 500 and (np.abs(got - own / 2) < 1).all()


def test_written_tables_leave_no_shuffle_files_and_the_session_as_it_was(spark):
    from reelsift import session

    key, before = session._CLEAN_UP, spark.conf.get(session._CLEAN_UP, None)
    seen, folders = [], spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(folders.getAllFiles()) if f.getName().startswith("shuffle_")}
    had = shuffled()
    with session._shuffles_removed(spark), session._shuffles_removed(spark):
        seen.append(spark.conf.get(key))
    out = session.written(spark.range(1000).repartition(4, "id"))
    assert out.count() == 1000 and seen == ["true"] and spark.conf.get(key, None) == before
    for _ in range(50):
        if shuffled() <= had:
            break
        time.sleep(0.1)
    assert shuffled() <= had
    spark.conf.set(key, "false")
    try:
        session.written(spark.range(10))
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
