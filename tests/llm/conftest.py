import pytest
from llm_helpers import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, n long, score double, part int"
BASE = "the quick brown fox jumps over the lazy dog while seven small birds sing in old green trees near water".split()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns that clash with inner names."""
    long = " ".join(prose(i, 400) for i in range(120))
    texts = [prose(1), prose(1), prose(2), "", None, " \n\t ", "one", "one two", "One TWO", prose(3) + "\x1c\u00a0x", long, long + " tail", "🙂 ß é\u0000x", "a" * 50_000]
    rows = [(i, t, "en", f"s{i % 3}", 1, "w", 1, 0.5, 1) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, prose(5), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [(100 + i, " ".join(BASE * 5 + [f"x{i}"]), "de", "hot", 1, None, None, None, None) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, odd_rows):
    rows = [(i, i % 2, int(i % 5 == 0), "extra") for i in range(0, 130)] + [(None, 1, 1, None), (3, None, None, None), (4, 7, 7, None), (5, 0, 0, "again")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
