"""queries() and oracle_sql() bodies, imported by __spark_entry__.py.

Every Spark result is normalised the same way for the oracle comparison:
integer columns become BIGINT, floats DOUBLE, doubles rounded to 6 places
(the oracle SQL rounds the same columns).
"""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions import round6
from reelsift.plans.registry import ORACLE, QUERIES

_MODULES = [
    "reelsift.plans.catalog_features",
    "reelsift.plans.catalog_recall",
    "reelsift.plans.catalog_io",
    "reelsift.plans.catalog_models",
]


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = round6(c.cast("double"))
        elif isinstance(f.dataType, T.DoubleType):
            c = round6(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def queries():
    _load()
    return {name: (lambda fn: (lambda spark, sf_dir: normalise(fn(spark, sf_dir))))(fn) for name, fn in QUERIES.items()}


def oracle_sql():
    _load()
    return dict(ORACLE)
