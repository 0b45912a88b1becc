"""Session helpers for tests and the bench, plus the shared scratch folder.

Library code never changes session state: it takes the caller's session.
``local_session`` is only for tests, the bench and the examples.
"""

from __future__ import annotations

import gc
import os
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SETTING, _inside = threading.Lock(), {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reelsift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("REELSIFT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only a ``local`` session without either, whose executors
    are the driver's own process, gets a folder under its warehouse; on a
    cluster an unset folder is an error."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/reelsift-checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder (round trips, KV store)."""
    return f"{checkpoint_base(spark).rstrip('/')}/reelsift-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What runs inside removes its shuffle files when it ends, not when the driver happens to collect its garbage.  The
    session's own setting is back afterwards."""
    with _SETTING:
        before = spark.conf.get(_CLEAN_UP, None)
        _inside[spark] = _inside.get(spark, (0, before))[0] + 1, _inside.get(spark, (0, before))[1]
        spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        with _SETTING:
            n, before = _inside.pop(spark)
            if n > 1:  # other threads are still inside
                _inside[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(_CLEAN_UP)
            else:
                spark.conf.set(_CLEAN_UP, before)


def written_at(df: DataFrame, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """``written`` and the folder."""
    path = scratch_dir(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back: evaluated once, lineage cut,
    safe when an executor is lost; nothing but the table stays on disk."""
    return written_at(df, partition_by)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``written_at`` that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def collected(spark: SparkSession) -> None:
    """Have the driver collect its garbage now: kept tables and shuffle files that nothing refers to any more leave the
    executors, which else waits until the driver's memory is full."""
    gc.collect()
    spark._jvm.System.gc()
