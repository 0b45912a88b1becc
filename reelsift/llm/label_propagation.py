"""Balanced label propagation: shards of equal row counts that keep equal texts together.

Documents with equal texts hang on a hub.  Every document starts in a shard by hash.  Large hubs (over an eighth of a
quota) are placed first, largest first: in the shard where most of their documents are of those with room, or, where none
has room, in as few pieces as fill whole shards.  Then the other hubs ask in rounds for the shard where most of their
documents are (or, when that is full, another with room), and requests are granted, large hubs first, up to each shard's
quota, until nothing fits; the few hubs that fit nowhere then are cut into pieces like large ones.  Documents without
links fill what is left, to exactly one row of difference.  All state after the first pass over the texts is a few numbers
a document; only tables of 40 rows, and the votes of 8 hubs a shard, reach the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.numbering import numbered
from reelsift.llm.scratch import written

ROWS_PER_BUCKET = 500
HUBS_PER_SHARD = 8  # placed on the driver at once; larger hubs than a quota's part of this can't be more


def _array(values):
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _granted(ask: DataFrame, free: list[int]) -> DataFrame:
    """Requests (hub, n, shard) within each shard's free rows: size classes downwards, hash order inside a class, up to
    the first that doesn't fit.  A shard grants one request at least if each is for no more than its free rows."""
    slot = (64 - F.floor(F.log2("n"))) * 256 + F.pmod(F.xxhash64("hub", F.lit(5)), F.lit(256))
    ask = written(ask.withColumn("slot", slot.cast("long")))
    total = ask.groupBy("shard", "slot").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = written(total.withColumn("before", before).where(F.col("before") < _array(free)[F.col("shard")]).select("shard", "slot", "before"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("shard", "slot").orderBy("hub").rowsBetween(Window.unboundedPreceding, 0))
    return ask.join(reached, ["shard", "slot"]).withColumn("upto", upto).where(F.col("upto") <= _array(free)[F.col("shard")]).select("hub", "n", "shard")


def place(hubs: list[tuple[int, int, dict[int, int]]], free: list[int]) -> dict[int, list[tuple[int, int]]]:
    """Pieces (rows, shard) of each hub (hub, n, votes by shard), largest first; ``free`` is reduced.  A hub that fits
    nowhere fills the shard with most room, and its rest queues again by its size: each cut fills a shard."""
    votes = {h: v for h, _, v in hubs}
    queue = [(-n, h) for h, n, _ in hubs]
    heapq.heapify(queue)
    out: dict[int, list[tuple[int, int]]] = {}
    while queue:
        n, h = heapq.heappop(queue)
        n = -n
        room = [s for s, f in enumerate(free) if f >= n]
        if room:
            s = max(room, key=lambda s: (votes[h].get(s, 0), free[s], -s))
        else:
            s = max(range(len(free)), key=lambda s: (free[s], votes[h].get(s, 0), -s))
        took = min(n, free[s])
        free[s] -= took
        out.setdefault(h, []).append((took, s))
        if took < n:
            heapq.heappush(queue, (took - n, h))
    return out


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 3) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and ``linked`` (kept with its hub or a piece of it), one
    row per row.

    A null text counts as empty; empty texts are equal texts.  Repeated rows and null doc_ids are rows like others.
    Tables with fewer rows than shards leave the last shards empty; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    meta = written(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 16).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit(seed), text, F.octet_length(text)).alias("k2"),
        )
    )
    rows = meta.count()
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    group = written(meta.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1"))
    linked = meta.join(group, ["k1", "k2"], "left")
    linked = written(linked.select("doc_id", "size", "text_crc32", F.when(F.col("n").isNotNull(), F.xxhash64("k1", "k2")).alias("hub")))

    start = F.pmod(F.xxhash64("doc_id", F.lit(seed + 2)), F.lit(shards)).cast("int")
    votes = written(linked.where("hub is not null").groupBy("hub", start.alias("shard")).agg(F.count("*").alias("c")))
    hubs = written(votes.groupBy("hub").agg(F.sum("c").alias("n")))
    free, few = list(quota), HUBS_PER_SHARD * shards
    pieces: dict[int, list[tuple[int, int]]] = {}

    def place_here(some: DataFrame) -> None:
        """Places ``some`` hubs (``few`` at most) on the driver."""
        wanted = votes.join(F.broadcast(some), "hub").groupBy("hub", "n").agg(F.map_from_entries(F.collect_list(F.struct("shard", "c"))).alias("votes"))
        pieces.update(place([(r["hub"], r["n"], r["votes"]) for r in wanted.collect()], free))

    large = F.col("n") * HUBS_PER_SHARD > quota[0]
    place_here(hubs.where(large))
    left, placed = hubs.where(~large), None
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    r = 0
    # ends: a round after the first places a hub wherever one has room, and hubs that fit nowhere are fewer than the shards
    while left.count() > few:
        choice = votes.join(left, "hub") if r == 0 else left.select("hub", "n", everywhere).join(votes, ["hub", "shard"], "left")
        room = (_array(free)[F.col("shard")] >= F.col("n")).cast("int")
        best = F.max(F.struct(room.alias("room"), F.coalesce("c", F.lit(0)).alias("c"), F.xxhash64("hub", "shard", F.lit(r)).alias("t"), "shard"))
        ask = choice.groupBy("hub", "n").agg(best.alias("m")).where("m.room = 1").select("hub", "n", F.col("m.shard").alias("shard"))
        won = written(_granted(ask, free))
        for x in won.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            free[x["shard"]] -= x["n"]
        placed = won if placed is None else placed.unionByName(won)
        left = written(left.join(won, "hub", "left_anti"))
        r += 1
    place_here(left)

    spark = docs.sparkSession
    one = spark.createDataFrame([(h, p[0][1]) for h, p in pieces.items() if len(p) == 1], "hub long, shard int")
    placed = one if placed is None else one.unionByName(placed.select("hub", "shard"))
    cut = [(h, [sum(n for n, _ in p[:i]) for i in range(len(p))], [s for _, s in p]) for h, p in pieces.items() if len(p) > 1]
    cut = F.broadcast(spark.createDataFrame(cut, "hub long, edges array<long>, shards array<int>"))
    alone = linked.where("hub is null").select("doc_id", "size", "text_crc32", F.lit(None).cast("int").alias("shard"))
    whole = linked.where("hub is not null").join(cut, "hub", "left_anti").join(placed, "hub").select("doc_id", "size", "text_crc32", "shard")
    cut = numbered(linked.join(cut, "hub"), ["hub"], F.xxhash64("doc_id", F.lit(seed + 1)), max(1, rows // ROWS_PER_BUCKET), ["doc_id", "text_crc32", "size"])
    cut = cut.withColumn("shard", F.col("shards")[F.size(F.filter("edges", lambda e: e <= F.col("idx"))) - 1])
    state = written(alone.unionByName(whole).unionByName(cut.select("doc_id", "size", "text_crc32", "shard")))
    key = F.xxhash64("doc_id", F.lit(seed + 3))
    fixed = numbered(state.where("shard is not null"), ["shard"], key, max(1, rows // (shards * ROWS_PER_BUCKET)), ["doc_id", "text_crc32", "size"])
    fixed = fixed.select("doc_id", "size", "text_crc32", "shard", F.col("idx").alias("slot"), F.lit(True).alias("linked"))
    rest = numbered(state.where("shard is null").drop("shard"), [], key, max(1, rows // ROWS_PER_BUCKET), ["doc_id", "text_crc32", "size"])
    edge = [sum(free[:s]) for s in range(shards)]
    # the last shard that begins at or before the row's number; full shards begin where the next one does
    rest = rest.withColumn("shard", (F.size(F.filter(_array(edge), lambda e: e <= F.col("idx"))) - 1).cast("int"))
    taken = [q - f for q, f in zip(quota, free, strict=True)]
    slot = _array(taken)[F.col("shard")] + F.col("idx") - _array(edge)[F.col("shard")]
    rest = rest.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), F.lit(False).alias("linked"))
    out = fixed.unionByName(rest)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked")
