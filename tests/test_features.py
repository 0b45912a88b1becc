from pyspark.sql import functions as F

from reelsift.operators import item_features as itf
from reelsift.operators import user_features as uf
from reelsift.operators.samples import add_label, rating_distribution
from reelsift.operators.training import build_samples

ITEMS = [(1, "A (2000)", "X|Y"), (2, "B (2010)", "Y"), (3, "C (1990)", "Z|X"), (4, "D", "")]


def _ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double, ts bigint")


def test_window_frame_is_cut_at_history(spark):
    rows = [(1, (i % 3) + 1, 4.0, 1000 + i) for i in range(150)]
    samples = add_label(_ratings(spark, rows)).withColumn("release_year", F.lit(2000)).withColumn("genres", F.lit("X"))
    out = uf.add_user_features(samples, history=100, keep_first=True).orderBy("ts").collect()
    counts = [r.user_rating_count for r in out]
    assert counts[:3] == [0, 1, 2] and counts[100] == 100 and counts[-1] == 100
    out20 = uf.add_user_features(samples, history=20).collect()
    assert max(r.user_rating_count for r in out20) == 20 and min(r.user_rating_count for r in out20) == 2


def test_tied_timestamps_order_by_item(spark):
    rows = [(7, 3, 5.0, 100), (7, 1, 5.0, 100), (7, 2, 5.0, 100), (7, 4, 1.0, 200)]
    samples = add_label(_ratings(spark, rows)).withColumn("release_year", F.lit(2000)).withColumn("genres", F.lit("X|Y"))
    last = [r for r in uf.add_user_features(samples).collect() if r.item_id == 4][0]
    assert [last.user_rated_movie1, last.user_rated_movie2, last.user_rated_movie3] == [3, 2, 1]
    assert last.user_genre1 == "X" and last.user_genre2 == "Y"


def test_preferred_genres_by_count_then_name(spark):
    df = spark.createDataFrame([(["B|A", "B|C", "C"],), ([],)], "h array<string>")
    got = [r.g for r in df.select(uf.preferred_genres(F.col("h")).alias("g")).collect()]
    assert got == [["B", "C", "A"], []]


def test_user_with_no_positives_and_few_rows(spark):
    rows = [(1, 1, 1.0, 1), (1, 2, 2.0, 2), (1, 3, 1.0, 3), (2, 1, 4.0, 1)]
    items = spark.createDataFrame(ITEMS, "item_id bigint, title string, genres string")
    s = build_samples(_ratings(spark, rows), items).collect()
    assert len(s) == 1 and s[0].user_id == 1 and s[0].user_rated_movie1 is None and s[0].user_genre1 is None
    assert s[0].user_avg_rating == "1.50" and s[0].user_rating_stddev == "0.71"


def test_item_stats_single_rating_stddev_zero(spark):
    st = itf.item_stats(_ratings(spark, [(1, 9, 3.0, 1), (1, 8, 2.0, 1), (2, 8, 4.0, 2)])).orderBy("item_id").collect()
    assert [(r.item_id, r.movie_rating_count, r.movie_avg_rating, r.movie_rating_stddev) for r in st] == [
        (8, 2, "3.00", "1.41"), (9, 1, "3.00", "0.00")]


def test_top_ratings_earlier_wins_ties(spark):
    rows = [(u, 1, 5.0 if u < 12 else 1.0, 100 - u) for u in range(20)]
    items = spark.createDataFrame(ITEMS, "item_id bigint, title string, genres string")
    top = itf.top_ratings(_ratings(spark, rows), items).collect()
    assert len(top) == 10 and all(r.rating == 5.0 for r in top)
    assert sorted(r.user_id for r in top) == list(range(2, 12))  # smallest ts among the 5.0s


def test_latest_per_key_and_profile(spark):
    r = _ratings(spark, [(1, 1, 4.0, 5), (2, 1, 2.0, 5), (1, 2, 5.0, 1)])
    assert {(x.user_id, x.item_id) for x in uf.last_item(r).collect()} == {(1, 1), (2, 1)}
    p = {x.user_id: x for x in uf.user_profile(r).collect()}
    assert p[1].highest_rating == 5.0 and p[1].lowest_rating == 4.0 and p[1].rating_count == 2
    dist = {x.rating: x.percentage for x in rating_distribution(r).collect()}
    assert abs(sum(dist.values()) - 1.0) < 1e-12


def _canon_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_heavy_user_blocked_path_matches_plain(spark):
    from reelsift.sources import canonical as cv

    r, i = cv.ratings(spark, "/root/testdata/sf0.001"), cv.items(spark, "/root/testdata/sf0.001")
    samples = itf.add_item_features(add_label(r), i).cache()
    plain = uf.add_user_features(samples, history=5, heavy_rows=None)
    # every user with more than 10 samples goes through range positions and 7-row blocks
    blocked = uf.add_user_features(samples, history=5, heavy_rows=10, block_rows=7)
    assert _canon_rows(blocked) == _canon_rows(plain)


def test_heavy_150_row_user_frame_100(spark):
    rows = [(1, i + 10, float(1 + i % 5), 1000 + i // 3) for i in range(150)] + [(2, 5, 4.0, 1)]
    samples = add_label(_ratings(spark, rows)).withColumn("release_year", F.lit(2000)).withColumn("genres", F.lit("X|Y"))
    plain = uf.add_user_features(samples, keep_first=True, heavy_rows=None)
    blocked = uf.add_user_features(samples, keep_first=True, heavy_rows=100, block_rows=100)
    assert _canon_rows(blocked) == _canon_rows(plain)


def test_heavy_item_sequences_match_plain(spark):
    from reelsift.operators.embedding import item_sequences
    from reelsift.sources import canonical as cv

    r = cv.ratings(spark, "/root/testdata/sf0.001")
    a = item_sequences(r, heavy_rows=None)
    b = item_sequences(r, heavy_rows=3)
    assert a.columns == b.columns and _canon_rows(a) == _canon_rows(b)


def test_sequences_are_whole_and_only_sentences_are_cut(spark):
    from reelsift.operators.embedding import item_sequences, sentences, sequence_strings

    n = 1001
    r = _ratings(spark, [(1, 100_000 * (i % 3) + i, 4.0, i) for i in range(n)] + [(2, 7, 5.0, 1), (2, 8, 1.0, 2)])
    s = item_sequences(r)
    assert s.where("user_id = 1").count() == n and s.agg(F.max("pos")).first()[0] == n - 1
    whole = {x.user_id: x for x in sequence_strings(s).collect()}
    assert whole[1].seq_len == n and whole[1].item_seq.split(" ") == [str(100_000 * (i % 3) + i) for i in range(n)]
    assert whole[2].item_seq == "7"
    cut = {(x.user_id, x.chunk): x["items"] for x in sentences(s).collect()}
    assert sorted((k, len(v)) for k, v in cut.items()) == [((1, 0), 1000), ((1, 1), 1), ((2, 0), 1)]


def test_whole_lists_extend_the_slots(spark):
    rows = [(1, i, 4.0, i) for i in range(12)]
    samples = add_label(_ratings(spark, rows)).withColumn("release_year", F.lit(2000)).withColumn("genres", F.lit("A|B|C|D|E|F|G"))
    last = uf.add_user_features(samples, lists=True).orderBy(F.desc("ts")).first()
    assert last.positive_history == list(range(10, -1, -1)) and last.preferred_genres == list("ABCDEFG")
    assert [last[f"user_rated_movie{i}"] for i in range(1, 6)] == last.positive_history[:5]


def test_numeric_twins_match_formatted_text(spark):
    from reelsift.sources import canonical as cv

    r, i = cv.ratings(spark, "/root/testdata/sf0.001"), cv.items(spark, "/root/testdata/sf0.001")
    samples = itf.add_item_features(add_label(r), i)
    plain = uf.add_user_features(samples, heavy_rows=None)
    twins = uf.add_user_features(samples, heavy_rows=None, numeric=True)
    assert twins.columns[: len(plain.columns)] == plain.columns
    for row in twins.limit(300).collect():
        for text, num in (("user_avg_rating", "user_avg_rating_num"), ("user_rating_stddev", "user_rating_stddev_num"),
                          ("user_release_year_stddev", "user_release_year_stddev_num")):
            assert abs(float(row[text].replace(",", "")) - row[num]) <= 0.005 + 1e-9


def test_build_samples_numeric_twins(spark):
    from reelsift.sources import canonical as cv

    r, i = cv.ratings(spark, "/root/testdata/sf0.001"), cv.items(spark, "/root/testdata/sf0.001")
    s = build_samples(r, i, numeric=True)
    for c in ("movie_avg_rating_num", "movie_rating_stddev_num", "user_avg_rating_num"):
        assert c in s.columns
    for row in s.limit(200).collect():
        assert abs(float(row.movie_avg_rating.replace(",", "")) - row.movie_avg_rating_num) <= 0.005 + 1e-9
    assert build_samples(r, i).columns == [c for c in s.columns if not c.endswith("_num")]
