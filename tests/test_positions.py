from pyspark.sql import functions as F

from reelsift.operators.positions import blocks, heavy_positions


def test_positions_carry_across_arrow_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")  # force many small batches per partition
    try:
        rows = [(k, t) for k in (1, 2, 3) for t in range(0, 40 if k == 2 else 7)]
        df = spark.createDataFrame(rows, "k bigint, t bigint")
        pos = heavy_positions(df, "k", ["t"], total_rows=len(rows), rows_per_partition=10).collect()
        got = {(r.k, r.t): r.pos for r in pos}
        assert got == {(k, t): t for k, t in rows}
    finally:
        spark.conf.set(key, old)


def test_blocks_copy_context(spark):
    df = spark.createDataFrame([(1, p) for p in range(10)], "k bigint, pos bigint")
    b = blocks(df, block_rows=4, context=2).collect()
    own = sorted((r.pos, r._block) for r in b if not r._ctx)
    ctx = sorted((r.pos, r._block) for r in b if r._ctx)
    assert own == [(p, p // 4) for p in range(10)]
    assert ctx == [(2, 1), (3, 1), (6, 2), (7, 2)]
