"""Generations of a key-value store on a shared file system.

    <store>/_claims/<version>      a version's claim: made once, by one writer
    <store>/_abandoned/<version>   claims whose writer is known to be lost
    <store>/_buckets/<n>           number of key buckets, fixed by the first write
    <store>/kind=delta/version=<version>/prefix=../bucket=../   entries of one write, one row a key
    <store>/kind=full/version=<version>/prefix=../bucket=../    the whole store as of that version

A reader takes the newest complete ``full`` and the complete deltas after it; the newest version of a key counts.
Compaction merges them into a new ``full``, where the newest entry wins once and for all and expired entries go, so what
a read touches is the live entries and a bounded number of deltas, however often keys are written.  What a reader of the
previous ``full`` may still be reading stays until the next compaction.  A generation without Spark's success marker
(a lost writer) is never read, and compaction stops before it until it is complete or abandoned: no write that ends late
is passed over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16
COMPACT_AFTER = 8  # generations to read at most
SCHEMA = "key string, value string, features map<string,string>, expires_at bigint, kind string, version bigint, prefix string, bucket int"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _mark(spark: SparkSession, path: str) -> bool:
    """Makes an empty file; False if it is there already.  The file system makes it for one caller only."""
    fs, place = _files(spark, path)
    try:
        return fs.createNewFile(place)
    except Exception as e:  # noqa: BLE001 -- a file system may also say so by its own exception
        if "AlreadyExists" in str(e):
            return False
        raise


def buckets(spark: SparkSession, path: str) -> int | None:
    """The store's number of buckets: the smallest marked one, should two first writers have met."""
    return min((int(n) for n in _names(spark, f"{path}/_buckets")), default=None)


def _generations(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, full or delta) of the complete generations, in order."""
    found = []
    for kind in ("delta", "full"):
        for name in _names(spark, f"{path}/kind={kind}"):
            if name.startswith("version=") and "_SUCCESS" in _names(spark, f"{path}/kind={kind}/{name}"):
                found.append((int(name.removeprefix("version=")), kind))
    return sorted(found)


def live(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The generations that make up the store now: the newest full one and the deltas after it."""
    found = _generations(spark, path)
    base = max((v for v, kind in found if kind == "full"), default=-1)
    return [(v, kind) for v, kind in found if v > base or (v == base and kind == "full")]


def pending(spark: SparkSession, path: str) -> list[int]:
    """Claimed versions that are neither complete nor abandoned: still being written, or lost."""
    claimed, gone = ({int(n) for n in _names(spark, f"{path}/{d}")} for d in ("_claims", "_abandoned"))
    base = max((v for v, kind in _generations(spark, path) if kind == "full"), default=0)
    return sorted(v for v in claimed - gone - {v for v, _ in _generations(spark, path)} if v > base)


def abandon(spark: SparkSession, path: str, version: int) -> None:
    """Says that the writer of a pending version is lost, so that compaction may go past it."""
    _mark(spark, f"{path}/_abandoned/{version}")


def _claim(spark: SparkSession, path: str, version: int | None) -> int:
    while True:
        last = max((int(n) for n in _names(spark, f"{path}/_claims")), default=0)
        wanted = last + 1 if version is None else int(version)
        if version is not None and wanted <= last:
            raise ValueError(f"version {wanted} is not after version {last} of {path}")
        if _mark(spark, f"{path}/_claims/{wanted}"):
            return wanted
        if version is not None:
            raise ValueError(f"version {wanted} of {path} is being written by another")


def _write(kv: DataFrame, path: str, n: int) -> None:
    """One row a key, one file a bucket."""
    placed = kv.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")).repartition("prefix", "bucket")
    placed.write.mode("error").partitionBy("prefix", "bucket").parquet(path)


def add(kv: DataFrame, path: str, version: int | None = None, whole: bool = False, n_buckets: int = BUCKETS) -> int:
    """Writes entries (prefix, key, value, features, expires_at) as a generation and returns its version.  A key that is
    there twice keeps its largest value (then its largest features as text, then the latest expiry)."""
    spark = kv.sparkSession
    n = buckets(spark, path)
    if n is None:
        _mark(spark, f"{path}/_buckets/{n_buckets}")
        n = buckets(spark, path)
    version = _claim(spark, path, version)
    order = F.struct(F.coalesce("value", F.lit("")), F.coalesce(F.to_json(F.sort_array(F.map_entries("features"))), F.lit("")), F.coalesce("expires_at", F.lit(2**63 - 1)))
    one = kv.groupBy("prefix", "key").agg(F.max_by(F.struct("value", "features", "expires_at"), order).alias("r"))
    rows = one.select("prefix", "key", "r.value", "r.features", "r.expires_at")
    _write(rows, f"{path}/kind={'full' if whole else 'delta'}/version={version}", n)
    return version


def _read(spark: SparkSession, path: str, generations: list[tuple[int, str]], prefix: str | None, keys: Sequence[str] | None) -> DataFrame:
    if not generations:
        return spark.range(0).select(F.from_json(F.lit(None).cast("string"), SCHEMA).alias("r")).select("r.*")
    kv = spark.read.schema(SCHEMA).option("basePath", path).parquet(*(f"{path}/kind={kind}/version={version}" for version, kind in generations)).drop("kind")
    if prefix is not None:
        kv = kv.where(F.col("prefix") == prefix)
    if keys is not None:
        n = buckets(spark, path)
        row = spark.range(1).select(F.array(*(F.pmod(F.xxhash64(F.lit(k)), F.lit(n)).cast("int") for k in keys)).alias("b")).first()
        kv = kv.where(F.col("bucket").isin(sorted(set(row["b"]))) & F.col("key").isin(list(keys)))
    if len(generations) == 1:
        return kv  # one row a key already
    entry = F.max_by(F.struct("value", "features", "expires_at", "version"), "version").alias("r")
    return kv.groupBy("prefix", "bucket", "key").agg(entry).select("prefix", "bucket", "key", "r.value", "r.features", "r.expires_at", "r.version")


def newest(spark: SparkSession, path: str, prefix: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """The newest entry of each key, of one prefix and of some keys only where given: their buckets alone are read."""
    return _read(spark, path, live(spark, path), prefix, keys)


def compact(spark: SparkSession, path: str, as_of: int | None = None) -> int | None:
    """Merges the live generations up to the first pending one into a full one, without entries expired at ``as_of``, and
    drops what the previous full generation had already replaced.  Returns the version it stands for, None if there is
    nothing to merge."""
    wait = min(pending(spark, path), default=None)
    now = [(v, kind) for v, kind in live(spark, path) if wait is None or v < wait]
    if not now or (len(now) == 1 and now[0][1] == "full" and as_of is None):
        return now[0][0] if now else None
    base = now[0][0] if now[0][1] == "full" else -1
    version = now[-1][0]
    rows = _read(spark, path, now, None, None)
    if as_of is not None:
        rows = rows.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(as_of)))
    if version == base:  # a full generation of this version is there: entries only expire, as a write of the next version
        version = _claim(spark, path, None)
        gone = {int(n) for n in _names(spark, f"{path}/_abandoned")}
        if any(base < int(n) < version and int(n) not in gone for n in _names(spark, f"{path}/_claims")):
            abandon(spark, path, version)  # another write came in between, which this generation would pass over
            return base
    _write(rows.drop("bucket", "version"), f"{path}/kind=full/version={version}", buckets(spark, path))
    fs, _ = _files(spark, path)
    for v, kind in _generations(spark, path):
        if v < base or (v == base and kind == "delta"):
            fs.delete(_files(spark, f"{path}/kind={kind}/version={v}")[1], True)
    return version
