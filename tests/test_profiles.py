import random

from reelsift.operators import profiles
from reelsift.operators.user_features import last_item, user_profile


def test_folding_days_equals_the_whole(spark):
    r = random.Random(4)
    rows = [(u, i, r.choice([0.5, 2.0, 3.5, 5.0]), r.randint(0, 50)) for u in range(20) for i in range(r.randint(1, 30))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")
    parts = [profiles.profile_state(df.where(f"ts % 4 = {k}")) for k in range(4)]
    order = lambda d: sorted(map(tuple, d.collect()))
    whole = order(profiles.profile_of(profiles.profile_state(df)))
    assert order(profiles.profile_of(profiles.merge_states(*parts))) == whole
    # any bracketing
    assert order(profiles.profile_of(profiles.merge_states(parts[0], profiles.merge_states(parts[3], parts[2], parts[1])))) == whole
    plain = order(user_profile(df).join(last_item(df), "user_id").select("user_id", "average_rating", "highest_rating", "lowest_rating", "rating_count", "item_id"))
    assert [tuple(round(x, 9) for x in p) for p in plain] == [tuple(round(x, 9) for x in p) for p in whole]


def test_no_ratings_and_missing_ones(spark):
    df = spark.createDataFrame([(1, 7, None, 3), (2, 8, 4.0, 1), (2, 9, None, 5)], "user_id long, item_id long, rating double, ts long")
    assert sorted(map(tuple, profiles.profile_of(profiles.profile_state(df)).collect())) == [(1, None, 0.0, 5.0, 0, 7), (2, 4.0, 4.0, 4.0, 1, 9)]
    assert profiles.profile_of(profiles.merge_states(profiles.profile_state(df.limit(0)))).count() == 0
