"""Property tests: column expressions against small Python models on random inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsift.functions import genre_array
from reelsift.operators.user_features import preferred_genres

GENRE = st.sampled_from(["A", "B", "C", "Drama", "Sci-Fi", ""])
GENRE_STRING = st.lists(GENRE, min_size=1, max_size=4).map("|".join)


def _java_split(s):
    """The serving side's rule: blank -> no genres; split on '|' dropping trailing empty pieces."""
    if s is None or s.strip() == "":
        return []
    parts = s.split("|")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _preferred(strings):
    c = Counter(g for s in strings for g in s.split("|"))
    return [g for g, _ in sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(GENRE_STRING, max_size=8), min_size=1, max_size=6))
def test_preferred_genres_matches_model(spark, histories):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(histories)], "i int, h array<string>")
    got = {r.i: r.g for r in df.select("i", preferred_genres(F.col("h")).alias("g")).collect()}
    for i, h in enumerate(histories):
        assert got[i] == _preferred(h)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="AB| ", max_size=8)), min_size=1, max_size=8))
def test_genre_array_matches_java_split(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, g string")
    got = {r.i: r.a for r in df.select("i", genre_array("g").alias("a")).collect()}
    for i, v in enumerate(values):
        assert got[i] == _java_split(v), (v, got[i])


def _year_model(title, default, unparsed):
    if title is None or len(title.strip()) < 6:
        return default
    t = title.strip()
    piece = t[-5:-1]
    try:
        return int(piece.strip()) if piece.strip().lstrip("+-").isdigit() else unparsed
    except ValueError:
        return unparsed


def _title_model(title):
    if title is None:
        return None
    t = title.strip()
    if len(t) >= 6 and _year_model(t, None, None) is not None:
        return t[:-6].strip()
    return t


TITLE = st.one_of(
    st.none(),
    st.text(alphabet="ab (", max_size=6).flatmap(lambda s: st.sampled_from([f"{s} (1995)", f"{s}(2001) ", f"{s} (ab1)", s])),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TITLE, min_size=1, max_size=8))
def test_title_rules_match_model(spark, titles):
    from reelsift.functions import clean_title, release_year

    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string")
    rows = {r.i: r for r in df.select("i", release_year("t").alias("y"), release_year("t", 0, 0).alias("s"),
                                      clean_title("t").alias("c")).collect()}
    for i, t in enumerate(titles):
        assert rows[i].y == _year_model(t, 1990, None), t
        assert rows[i].s == _year_model(t, 0, 0), t
        assert rows[i].c == _title_model(t), t
