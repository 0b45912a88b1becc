from pyspark.sql import functions as F

from reelsift.sinks import files as sk
from reelsift.sinks import kv as skv
from reelsift.sources import files as src
from reelsift.sources import kv as skr


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_strict_items_loader(spark, tmp_out):
    p = tmp_out + "/movies"
    _write_lines(spark, p, ["movieId,title,genres", '1,Toy Story (1995),A|B', '2,"Heat, The (1995)",C', "3,Two fields",
                            "4,Four,fields,here", "5,Blank genre (2001), ", "6,Short,X"])
    got = {r.item_id: r for r in src.load_items_strict(spark, p).collect()}
    assert set(got) == {1, 5, 6}
    assert got[1].title == "Toy Story" and got[1].release_year == 1995 and got[1].genre_list == ["A", "B"]
    assert got[5].genre_list == [] and got[6].release_year == 0


def test_strict_ratings_loader(spark, tmp_out):
    p = tmp_out + "/ratings"
    _write_lines(spark, p, ["userId,movieId,rating,timestamp", "1,2,3.5,964982703", "1,3,4.0", "1,4,4.0,5,6", "1,5,abc,964982703",
                            "2,6,1.0,1000000000"])
    got = sorted((r.user_id, r.item_id, r.rating, r.ts) for r in src.load_ratings_strict(spark, p).collect())
    assert got == [(1, 2, 3.5, 964982703), (2, 6, 1.0, 1000000000)]


def test_csv_reader_keeps_quoted_commas(spark, tmp_out):
    p = tmp_out + "/movies_csv"
    _write_lines(spark, p, ["movieId,title,genres", '2,"Heat, The (1995)",C'])
    assert src.read_items_csv(spark, p).collect()[0].title == "Heat, The (1995)"


def test_embedding_text_and_last_wins(spark, tmp_out):
    a, b = tmp_out + "/a", tmp_out + "/b"
    _write_lines(spark, a, ["1:0.5 1.5", "2:1 2:3", "3:1  2", "x:1 2", "4:1 2"])
    _write_lines(spark, b, ["4:9 9"])
    one = {r.item_id: r.emb for r in src.read_embeddings(spark, a).collect()}
    assert one == {1: [0.5, 1.5], 4: [1.0, 2.0]}
    multi = {r.item_id: r.emb for r in src.read_embeddings_multi(spark, [a, b]).collect()}
    assert multi[4] == [9.0, 9.0] and multi[1] == [0.5, 1.5]


def test_embedding_round_trip(spark, tmp_out):
    df = spark.createDataFrame([(1, [0.1, -2.5, 3.0e-5])], "item_id bigint, emb array<float>")
    sk.write_embeddings(df, tmp_out + "/e")
    back = src.read_embeddings(spark, tmp_out + "/e").collect()
    assert back[0].emb == df.collect()[0].emb


def test_kv_ttl_and_prefixes(spark, tmp_out):
    e = spark.createDataFrame([(1, [1.0, 2.0])], "item_id bigint, emb array<float>")
    u = spark.createDataFrame([(7, [3.0])], "user_id bigint, emb array<float>")
    skv.write_kv(skv.to_kv_embeddings(e, "i2vEmb", "item_id", as_of=0, ttl=100), tmp_out)
    skv.write_kv(skv.to_kv_embeddings(u, "uEmb", "user_id", as_of=0, ttl=1000), tmp_out)
    assert skr.read_kv_embeddings(spark, tmp_out, "i2vEmb", as_of=50).count() == 1
    assert skr.read_kv_embeddings(spark, tmp_out, "i2vEmb", as_of=150).count() == 0
    assert skr.read_kv_embeddings(spark, tmp_out, "uEmb", "user_id", as_of=150).collect()[0].emb == [3.0]
    feats = spark.createDataFrame([(5, None, "B", None, 3, 1995, "4.00", "0.00")],
                                  "item_id bigint, movie_genre1 string, movie_genre2 string, movie_genre3 string, "
                                  "movie_rating_count bigint, release_year int, movie_avg_rating string, movie_rating_stddev string")
    skv.write_kv(skv.item_feature_kv(feats), tmp_out)
    f = skr.read_kv_features(spark, tmp_out, "mf").collect()[0].features
    assert f["movieGenre1"] == "" and f["movieGenre2"] == "B" and f["releaseYear"] == "1995" and len(f) == 7


def test_samples_csv_round_trip(spark, tmp_out):
    df = spark.createDataFrame([(1, "1,234.00", None), (2, "", "x")], "id bigint, a string, b string")
    sk.write_samples(df, tmp_out + "/s")
    back = sorted(spark.read.schema(df.schema).option("header", True).csv(tmp_out + "/s").collect())
    assert back[0].a == "1,234.00" and back[0].b is None and back[1].b == "x"


def test_epoch_day_is_zone_free(spark):
    import datetime

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from reelsift.sources.canonical import epoch_day

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        ntz = spark.createDataFrame([(datetime.datetime(1995, 3, 1, 0, 30),)], T.StructType([T.StructField("t", T.TimestampNTZType())]))
        ltz = spark.createDataFrame([(1,)], "x int").select(F.expr("timestamp_micros(794017800000000)").alias("t"))  # 1995-03-01 00:30 UTC
        a = ntz.select(epoch_day(F.col("t"), T.TimestampNTZType()).alias("d")).first().d
        b = ltz.select(epoch_day(F.col("t"), T.TimestampType()).alias("d")).first().d
        assert a == b == (datetime.date(1995, 3, 1) - datetime.date(1970, 1, 1)).days
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_canonical_views_conform_and_round_trip(spark, tmp_out):
    from reelsift import schema
    from reelsift.operators.embedding import user_embeddings
    from reelsift.sources import canonical as cv

    sf = "/root/testdata/sf0.001"
    frames = {"ratings": cv.ratings(spark, sf), "items": cv.items(spark, sf), "links": cv.links(spark, sf),
              "item_emb": cv.item_emb(spark, sf)}
    frames["user_emb"] = user_embeddings(frames["ratings"], frames["item_emb"])
    for name, df in frames.items():
        assert schema.conforms(df, name), (name, df.schema.simpleString())
    frames["ratings"].write.parquet(tmp_out + "/ratings")
    back = schema.read_table(spark, tmp_out + "/ratings", "ratings")
    assert back.count() == frames["ratings"].count() and schema.conforms(back, "ratings")


def test_kv_last_write_of_a_key_wins(spark, tmp_out):
    from reelsift.sinks import kv as skv
    from reelsift.sources import kv as skr

    e = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "item_id bigint, emb array<float>")
    skv.write_kv(skv.to_kv_embeddings(e, "i2vEmb"), tmp_out)
    skv.write_kv(skv.to_kv_embeddings(e, "i2vEmb"), tmp_out)
    assert skr.read_kv_embeddings(spark, tmp_out, "i2vEmb").count() == 2
    skv.write_kv(skv.to_kv_embeddings(e.where("item_id = 2").withColumn("emb", F.array(F.lit(9.0))), "i2vEmb"), tmp_out)
    assert {r.item_id: r.emb for r in skr.read_kv_embeddings(spark, tmp_out, "i2vEmb").collect()} == {1: [1.0], 2: [9.0]}
    skv.write_kv(skv.to_kv_embeddings(e.where("item_id = 1"), "i2vEmb", as_of=0, ttl=10), tmp_out)  # newest, and expired at 50
    assert [r.item_id for r in skr.read_kv_embeddings(spark, tmp_out, "i2vEmb", as_of=50).collect()] == [2]


def test_feature_switch(spark, tmp_out):
    from reelsift.sources import kv as skr

    off = skr.load_features(spark, False, tmp_out, "mf")
    assert off.columns == ["item_id", "features"] and off.count() == 0


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    import types

    import pytest

    from reelsift import session

    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_base(types.SimpleNamespace(sparkContext=sc, conf=conf))


def test_stored_features_are_joined_without_the_driver(spark):
    """Neither of the two joins broadcasts the feature maps, however small their files look."""
    import __spark_entry__ as e

    for name, id_col in (("join_kv_features", "item_id"), ("join_kv_user_features", "user_id")):
        df = e.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "features" in plan
        assert f"BroadcastHashJoin [{id_col}" not in plan, name


def test_item_columns_of_samples_are_not_broadcast(spark):
    import __spark_entry__ as e

    plan = e.queries()["item_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    titles = plan.index("part.parquet")
    assert "SortMergeJoin [item_id" in plan and "BroadcastExchange" not in plan[plan.index("SortMergeJoin [item_id") : titles]
