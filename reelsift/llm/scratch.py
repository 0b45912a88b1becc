"""Tables written to the cluster's shared checkpoint folder: they cut lineage, survive a lost executor, and carry no
partitioning over, so later joins shuffle both sides and AQE can split a hot key.  And small tables from the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from reelsift.session import written

__all__ = ["small_table", "written"]


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a DataFrame, sent as an Arrow table: a Python list would start a second pool of Python
    workers on the executors, whose memory stays."""
    fields = to_arrow_schema(_parse_datatype_string(schema))
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), schema)
