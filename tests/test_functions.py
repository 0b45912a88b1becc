import math

from pyspark.sql import functions as F

from reelsift.functions import clean_title, cosine100, fmt2, genre_array, genre_slot, release_year, round6, uniform

TITLES = [("Toy Story (1995)",), ("Heat (1995) ",), ("No year here",), ("Odd (abcd)",), ("Up",), (None,)]


def test_release_year_and_title(spark):
    df = spark.createDataFrame(TITLES, "title string")
    rows = df.select(
        release_year("title").alias("y"), release_year("title", 0, 0).alias("strict"), clean_title("title").alias("t")
    ).collect()
    assert [r.y for r in rows] == [1995, 1995, None, None, 1990, 1990]
    assert [r.strict for r in rows] == [1995, 1995, 0, 0, 0, 0]
    assert [r.t for r in rows] == ["Toy Story", "Heat", "No year here", "Odd (abcd)", "Up", None]


def test_genres(spark):
    df = spark.createDataFrame([("A|B|C|D",), ("A",), ("  ",), (None,), ("(no genres listed)",), ("A|B|",)], "g string")
    rows = df.select(genre_array("g").alias("a"), genre_slot("g", 2).alias("s3")).collect()
    assert [r.a for r in rows] == [["A", "B", "C", "D"], ["A"], [], [], ["(no genres listed)"], ["A", "B"]]
    assert [r.s3 for r in rows] == ["C", None, None, None, None, ""]


def test_fmt2_separators_and_rounding(spark):
    df = spark.createDataFrame([(1234.5678,), (2.125,), (0.0,), (None,)], "x double")
    assert [r.f for r in df.select(fmt2("x").alias("f")).collect()] == ["1,234.57", "2.12", "0.00", None]


def test_uniform_deterministic_in_unit_interval(spark):
    df = spark.range(2000).select(F.col("id"), uniform("id", seed=3).alias("u"), uniform("id", seed=3).alias("v"))
    rows = df.collect()
    assert all(0.0 <= r.u < 1.0 and r.u == r.v for r in rows)
    mean = sum(r.u for r in rows) / len(rows)
    assert abs(mean - 0.5) < 0.05


def test_cosine100_edge_cases(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 0.0]), ([1.0, 2.0], [-1.0, -2.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0]), (None, [1.0, 2.0])],
        "a array<double>, b array<double>",
    )
    got = [r.c for r in df.select(cosine100("a", "b").alias("c")).collect()]
    assert math.isclose(got[0], 100.0) and math.isclose(got[1], -100.0)
    assert got[2:] == [None, None, None]


def test_round6_half_away_on_scaled_value(spark):
    df = spark.createDataFrame([(0.2534375,), (-1.0000005,), (2.5e-7,)], "x double")
    got = [r.r for r in df.select(round6("x").alias("r")).collect()]
    assert got[0] in (0.253437, 0.253438) and got[2] in (0.0, 1e-6)
