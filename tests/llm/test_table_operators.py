import zlib
from collections import Counter

import numpy as np
from llm_helpers import split

from reelsift.llm import label_propagation, mix_tree
from reelsift.llm.numbering import numbered


def test_numbering_is_gapless(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("doc"))
    for buckets in (1, 7, 9000):
        got = numbered(df, ["k"], F.xxhash64("doc"), buckets, ["doc"]).collect()
        for k in range(3):
            mine = sorted(r.idx for r in got if r.k == k)
            assert mine == list(range(len(mine)))
    assert sorted(r.idx for r in numbered(df, [], F.xxhash64("doc"), 50, ["doc"]).collect()) == list(range(5000))


def check_shards(got, rows, shards):
    assert len(got) == len(rows)
    size = Counter(r.shard for r in got)
    counts = [size.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and all(0 <= r.shard < shards for r in got)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_shards(spark, odd, odd_rows, none):
    for shards in (3, 40):
        check_shards(label_propagation.shard_documents(odd, shards).collect(), odd_rows, shards)
    assert label_propagation.shard_documents(none).count() == 0


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i}" if i % 3 else f"group {i // 30}") for i in range(3000)] + [(10_000 + i, "hot") for i in range(1500)]
    got = label_propagation.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, rows, 10)
    text = dict(rows)
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for t, s in where.items() if t != "hot")
    assert len(where["hot"]) <= 5  # 1500 copies, 450 rows a shard


def shards_of(got, text):
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    return where


def test_large_groups_keep_together_among_small_ones(spark):
    """A third of the rows is one text, the others are groups of two to 80 rows: no room is left by itself."""
    rows = [(i, "hot") for i in range(4000)]
    while len(rows) < 12_000:
        n = min(12_000 - len(rows), (2, 7, 30, 80)[len(rows) % 4])
        rows += [(len(rows) + i, f"group {len(rows)}") for i in range(n)]
    got = label_propagation.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    check_shards(got, rows, 40)
    where = shards_of(got, dict(rows))
    assert len(where["hot"]) == 14  # 300 rows a shard: 13 whole shards and a rest
    cut = {t: len(s) for t, s in where.items() if len(s) > 1 and t != "hot"}
    assert len(cut) < 40 and sum(cut.values()) - len(cut) <= 40  # each cut fills a shard


def test_copies_of_one_id_over_a_quota(spark):
    rows = [(None, "same")] * 500 + [(i, f"text {i}") for i in range(500)]
    got = label_propagation.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, rows, 10)
    assert len({r.shard for r in got if r.doc_id is None}) == 5


def test_rounds_go_on_until_nothing_fits(spark, monkeypatch):
    monkeypatch.setattr(label_propagation, "HUBS_PER_SHARD", 2)
    rows = [(i, f"pair {i // 2}") for i in range(4000)]
    got = label_propagation.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check_shards(got, rows, 8)
    assert all(len(s) == 1 for s in shards_of(got, dict(rows)).values()) and all(r.linked for r in got)


def test_place_cuts_only_what_fits_nowhere():
    free = [10, 10, 10]
    assert label_propagation.place([(1, 14, {2: 9}), (2, 9, {2: 5}), (3, 3, {})], free) == {1: [(10, 2), (4, 1)], 2: [(9, 0)], 3: [(3, 1)]}
    assert free == [1, 3, 0]


def slow_targets(sizes, weights):
    left, capped = 1.5 * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        t = {i: left * weights[i] / sum(weights[j] for j in free) for i in free} if free else {}
        over = [i for i in free if t[i] > 2 * sizes[i]]
        if not over:
            return [capped.get(i, t.get(i)) for i in range(len(sizes))]
        for i in over:
            capped[i] = 2 * sizes[i]
            left -= capped[i]


def test_targets():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(0, 1000, 9).tolist()
        weights = [(5, 2, 1)[i % 3] for i in range(9)]
        assert np.allclose(mix_tree.targets(sizes, weights), slow_targets(sizes, weights))
    assert mix_tree.targets([], []) == [] and mix_tree.targets([0, 0], [5, 2]) == [0, 0]


def test_splitting_tree_is_exact():
    draws = np.array([100, 0, 37, 5])
    q = mix_tree.splitting_tree(draws, 7, np.random.default_rng(1))
    assert q.shape == (7, 4) and (q.sum(axis=0) == draws).all() and q.sum(axis=1).max() - q.sum(axis=1).min() <= 2
    assert (mix_tree.splitting_tree(draws, 7, np.random.default_rng(1)) == q).all()


def test_mixture(spark, odd, odd_rows, none):
    got = mix_tree.mixture(odd).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], len(split(r[1]))) for r in odd_rows)
    names = sorted({r[3] for r in odd_rows if r[3] is not None}) + [None]
    sizes = [sum(len(split(r[1])) for r in odd_rows if r[3] == s) for s in names]
    want = dict(zip(names, mix_tree.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    for s, size in zip(names, sizes, strict=True):
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {size} and abs(mine[0].target - want[s]) < 1e-6
        assert abs(sum(r.taken for r in mine) - want[s]) <= 4  # repeated rows share alike
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and sum(p.words for p in r.placements) == r.taken
        assert all(0 <= p.shard < mix_tree.SHARDS for p in r.placements)
    again = mix_tree.mixture(odd.repartition(9)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mix_tree.mixture(none).count() == 0


def test_mixed_documents(spark, odd, none):
    mixed = mix_tree.mixed_documents(odd)
    assert mixed.columns == odd.columns
    plan = {(r.doc_id, r.source): r.taken for r in mix_tree.mixture(odd).collect()}
    words = Counter()
    for r in mixed.collect():
        words[(r.doc_id, r.source)] += len(split(r.text))
    once = [k for k in plan if k[0] not in (0, None)]  # ids without repeated rows
    assert all(words[k] == plan[k] for k in once)
    assert mix_tree.mixed_documents(none).count() == 0


def test_mixed_documents_of_null_and_repeated_ids(spark):
    texts = ["a", "a b", "a  b\tc", "\u00a0x y\x0bz w", " ".join("w" * 9), "", None, "\n "]
    rows = [(d, " ".join([t] * k) if t else t, s) for d in (None, 1, 2) for s in ("s0", "s1", None) for t in texts for k in (1, 1, 3)]
    docs = spark.createDataFrame([*rows, *[(10 + i, "one two three", f"s{i % 2}") for i in range(40)]], "doc_id long, text string, source string")
    want, got = Counter(), Counter()
    for r in mix_tree.mixture(docs).collect():
        want[r.doc_id, r.source, "rows"] += len(r.placements)
        want[r.doc_id, r.source, "words"] += r.taken
    mixed = mix_tree.mixed_documents(docs).collect()
    for r in mixed:
        got[r.doc_id, r.source, "rows"] += 1
        got[r.doc_id, r.source, "words"] += len(split(r.text))
    assert got == want and len(mixed) <= 2 * docs.count()


def test_pipeline(spark, odd, none, labels, tmp_path):
    import corpus_pipeline
    from reelsift.llm.scratch import written

    odd.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "toxicity", "minmax_dedup", "mix_sources", "packing"]
    for start in (spark.read.parquet(f"{tmp_path}/documents.parquet"), none):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, str(tmp_path)))
            assert docs.columns == odd.columns
        assert stage is corpus_pipeline.mixed
        pieces = corpus_pipeline.packed(spark, docs, str(tmp_path))
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
