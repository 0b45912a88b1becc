"""Every query with an oracle matches DuckDB on sf0.001 (the driver checks sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"als_cv"}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sc, sr = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    dc, dr = _canon(rel.columns, rel.fetchall())
    assert sc == dc
    assert sr == dr


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "item_id", "score", "rank"] and df.count() > 0
