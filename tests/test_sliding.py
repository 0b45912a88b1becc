import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsift.operators import sliding
from reelsift.operators.user_features import add_user_features

SCHEMA = "user_id long, item_id long, ts long, rating double, label long, release_year int, genres string"


def rows_of(seed, users, most):
    r = random.Random(seed)
    out = []
    for u in [*range(users), None]:
        for i in range(r.randint(0, most)):
            genres = r.choice([None, "", "A", "B|A", "C|é|B", "Z|", "D|D"])
            rating = r.choice([0.5, 1.0, 3.5, 5.0, None, 3.7])
            out.append((u, i, r.randint(0, 20), rating, int((rating or 0) >= 3.5), r.choice([None, 1990, 2001, 2002]), genres))
    r.shuffle(out)
    return out


def brute(rows, history):
    by = {}
    for x in sorted(rows, key=lambda x: (x[2], x[1])):
        by.setdefault(x[0], []).append(x)
    out = {}
    for u, mine in by.items():
        for i, x in enumerate(mine):
            frame = mine[max(0, i - history) : i]
            liked = [f for f in frame if f[4] == 1]
            n = Counter(g for f in liked if f[6] is not None for g in f[6].split("|"))
            ratings, years = [f[3] for f in frame if f[3] is not None], [f[5] for f in frame if f[5] is not None]
            mean = lambda v: statistics.fmean(v) if v else None
            sd = lambda v: statistics.stdev(v) if len(v) > 1 else None
            genres = sorted(n, key=lambda g: (-n[g], g.encode()))
            out[u, x[1]] = ([f[1] for f in reversed(liked)], len(frame), mean(years), sd(years), mean(ratings), sd(ratings), genres)
    return out


def close(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


@pytest.mark.parametrize(("history", "chunk", "cells", "batch"), [(100, 2048, 1 << 21, 10_000), (3, 4, 8, 7), (5, 1, 1, 3), (1, 50, 64, 1)])
def test_frames_against_brute_force(spark, monkeypatch, history, chunk, cells, batch):
    monkeypatch.setattr(sliding, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(sliding, "CELLS", cells)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = rows_of(history, 12, 40)
        df = spark.createDataFrame(rows, SCHEMA)
        want = brute(rows, history)
        for slots in (None, 2):
            got = sliding.add_frames(df, ["user_id"], ["ts", "item_id"], ["user_id", "item_id"], history, slots).collect()
            assert len(got) == len(want)
            for g in got:
                hist, n, year, year_sd, rating, rating_sd, genres = want[g.user_id, g.item_id]
                assert (g._hist, g.user_rating_count, g._genres) == (hist[:slots], n, genres[:slots])
                assert close(g._avg_year, year) and close(g._year_sd, year_sd) and close(g._avg_rating, rating) and close(g._rating_sd, rating_sd)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_deviation_of_large_constants():
    x = np.full(5000, 1e9 + 0.1)
    x[:100] = 1e9  # the chunk's middle is not its first value
    at = np.arange(5000)
    _, mean, sd = sliding.moments(x, np.maximum(at - 100, 0), at)
    assert np.abs(mean[300:] - (1e9 + 0.1)).max() < 1e-6 and sd[300:].max() < 1e-6
    x = 1e9 + np.resize([0.0, 1.0], 5000)
    _, _, sd = sliding.moments(x, np.maximum(at - 100, 0), at)
    assert np.abs(sd[200:] - math.sqrt(25 / 99)).max() < 1e-9


def test_missing_and_infinite_numbers():
    x = np.array([np.nan, 1.0, np.inf, 3.0, 5.0])
    n, mean, sd = sliding.moments(x, np.array([0, 0, 0, 1, 3]), np.array([0, 1, 3, 3, 5]))
    assert n.tolist() == [0, 0, 2, 2, 2] and np.isnan(mean[:2]).all() and np.isinf(mean[2:4]).all() and mean[4] == 4.0
    assert np.isnan(sd[:4]).all() and abs(sd[4] - math.sqrt(2)) < 1e-12


def test_heavy_users_take_blocks_with_the_same_result(spark):
    rows = [(u, i, i // 3, 0.5 * (1 + (i * 7 + u) % 10), int((i * 7 + u) % 10 > 5), 1990 + i % 30, "A|B" if i % 2 else "C") for u in range(4) for i in range(400 if u == 1 else 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = add_user_features(df, history=10, heavy_rows=None, keep_first=True, lists=True)
    cut = add_user_features(df, history=10, heavy_rows=50, block_rows=64, keep_first=True, lists=True)
    order = lambda d: sorted(map(tuple, d.withColumn("positive_history", F.col("positive_history").cast("string")).collect()), key=repr)
    assert order(plain) == order(cut)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert add_user_features(df, keep_first=True).count() == 0
