import pytest
from pyspark.sql import functions as F

from reelsift.sinks import kv as skv
from reelsift.sources import kv as skr
from reelsift.sources import kv_store

SCHEMA = "prefix string, key string, value string, features map<string,string>, expires_at long"


def entries(spark, rows, prefix="p"):
    return spark.createDataFrame([(prefix, f"{prefix}:{k}", v, None, e) for k, v, e in rows], SCHEMA)


def seen(spark, path, prefix="p", **kw):
    return {r.key: r.value for r in skr.read_kv(spark, path, prefix, **kw).collect()}


def test_rewrites_do_not_add_files_to_read(spark, tmp_out):
    sizes = []
    for i in range(9):
        skv.write_kv(entries(spark, [(k, f"v{i}", None) for k in range(40)] + [(100 + i, "once", None)]), tmp_out, buckets=4, compact_after=3)
        assert len(kv_store.live(spark, tmp_out)) <= 3
        sizes.append(len(skr.read_kv(spark, tmp_out, "p").inputFiles()))
        got = seen(spark, tmp_out)
        assert got == {f"p:{k}": f"v{i}" for k in range(40)} | {f"p:{100 + j}": "once" for j in range(i + 1)}
    assert max(sizes) <= 3 * 4  # buckets of the full generation and of the deltas since
    assert len(kv_store._generations(spark, tmp_out)) <= 2 * 3 + 2  # what was replaced is gone, but for the last readers'


def test_two_writes_of_one_version_are_an_error(spark, tmp_out):
    skv.write_kv(entries(spark, [(1, "a", None)]), tmp_out, version=7)
    for version in (7, 6):
        with pytest.raises(ValueError, match="version"):
            skv.write_kv(entries(spark, [(1, "b", None)]), tmp_out, version=version)
    skv.write_kv(entries(spark, [(1, "c", None)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:1": "c"} and kv_store.live(spark, tmp_out)[-1][0] == 8


def test_expired_entries_go_on_compaction(spark, tmp_out):
    skv.write_kv(entries(spark, [(1, "old", None), (2, "stays", 500)]), tmp_out)
    skv.write_kv(entries(spark, [(1, "short", 10)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:1": "short", "p:2": "stays"} and seen(spark, tmp_out, as_of=50) == {"p:2": "stays"}
    kv_store.compact(spark, tmp_out, as_of=50)
    assert seen(spark, tmp_out) == {"p:2": "stays"}  # neither the expired entry nor the one it replaced
    kv_store.compact(spark, tmp_out, as_of=600)
    assert seen(spark, tmp_out) == {}
    skv.write_kv(entries(spark, [(1, "again", None)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:1": "again"}


def test_only_the_buckets_asked_for_are_read(spark, tmp_out):
    skv.write_kv(entries(spark, [(k, f"v{k}", None) for k in range(200)]).unionByName(entries(spark, [(1, "other", None)], "q")), tmp_out, buckets=8)
    found = skr.read_kv(spark, tmp_out, "p", keys=["p:3", "p:none"])
    assert {r.key: r.value for r in found.collect()} == {"p:3": "v3"}
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and "bucket#" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert seen(spark, tmp_out, "q") == {"q:1": "other"}


def test_a_lost_writers_generation_is_not_read(spark, tmp_out):
    skv.write_kv(entries(spark, [(1, "a", None)]), tmp_out)
    skv.write_kv(entries(spark, [(1, "half", None)]), tmp_out)
    fs, place = kv_store._files(spark, f"{tmp_out}/kind=delta/version=2/_SUCCESS")
    fs.delete(place, False)
    assert seen(spark, tmp_out) == {"p:1": "a"}
    skv.write_kv(entries(spark, [(2, "b", None)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:1": "a", "p:2": "b"}
    # it may yet end: compaction waits for it, until it is known to be lost
    assert kv_store.pending(spark, tmp_out) == [2]
    kv_store.compact(spark, tmp_out)
    assert kv_store.live(spark, tmp_out) == [(1, "full"), (3, "delta")]
    kv_store.abandon(spark, tmp_out, 2)
    kv_store.compact(spark, tmp_out)
    assert kv_store.live(spark, tmp_out) == [(3, "full")] and seen(spark, tmp_out) == {"p:1": "a", "p:2": "b"}


def test_a_key_twice_in_one_write_and_overwriting_all(spark, tmp_out):
    skv.write_kv(entries(spark, [(1, "a", None), (1, "b", None), (1, None, None)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:1": "b"}
    skv.write_kv(entries(spark, [(9, "z", None)]), tmp_out, mode="overwrite")
    assert seen(spark, tmp_out) == {"p:9": "z"}
    skv.write_kv(entries(spark, [(1, "c", None)]), tmp_out)
    assert seen(spark, tmp_out) == {"p:9": "z", "p:1": "c"}


def test_an_empty_store(spark, tmp_out):
    assert seen(spark, tmp_out) == {} and kv_store.compact(spark, tmp_out) is None
    skv.write_kv(entries(spark, [(1, "a", None)]).where(F.lit(False)), tmp_out)
    assert seen(spark, tmp_out) == {}
