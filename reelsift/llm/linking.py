"""From band keys to groups: candidates, exact confirmation and components, without pairing the rows of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.graph import components, jump
from reelsift.llm.scratch import written
from reelsift.llm.textkit import distinct_sets, hash_spans, long_list, mix, shingles, slices, words

CLASS = 1.02  # ratio of neighbouring size classes
ROUNDS = 2  # of few pairs a row, before all pairs of what is still apart


def shingle_sets(text: pa.Array, k: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    w = words(text)
    return distinct_sets(*shingles(hash_spans(w, lower), w.off, k))


def sketch_batch(b: pa.RecordBatch, k: int, lower: bool, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """doc_id, n_shingles, a 128-bit key of the set, and the band keys that ``keys(sets, offsets)`` gives for each
    non-empty set."""
    sets, off = shingle_sets(b.column("text"), k, lower)
    n = np.diff(off)
    full = np.flatnonzero(n)
    band = keys(sets, off)
    sums = np.zeros((2, len(n)), np.uint64)
    if len(full):
        sums[0, full] = np.add.reduceat(mix(sets), off[:-1][full])
        sums[1, full] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), off[:-1][full])
    band_off = np.concatenate([[0], np.cumsum((n > 0) * band.shape[1])])
    columns = [b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), long_list(band.reshape(-1), band_off)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def full_sets(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets, off = shingle_sets(b.column("text"), k, lower)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), long_list(sets, off)], names=["id", "shingles"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    size = F.size("sa") + F.size("sb")
    near = F.least(F.size("sa"), F.size("sb")) * 100 >= F.greatest(F.size("sa"), F.size("sb")) * percent
    joined = pairs.join(a, "a").join(b, "b")
    return joined.where(F.when(near, 100 * both >= percent * (size - both)).otherwise(False)).select("a", "b")


def _entries(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(main, e, id, n, least, top): the shingles at which the ``rows`` (main, id) of one ``main`` meet.  Every pair that
    can have 100 * intersection >= percent * union meets, and rows that share only a core too small for it never do.

    Under one ``main`` all sets are read in one order: shingles outside main's own set, rare ones first, then those of
    main.  Two sets whose first common shingle has ``at`` others before it share ``n - at`` at most, which bounds the
    partner's size by ``top``.  They meet at that shingle and at the partner's size class, so a family under the
    threshold, whose rows have too many shingles of their own before the core, makes no pairs.
    """
    pivot, own = sets.select(F.col("id").alias("main"), F.col("shingles").alias("p")), sets.select("id", F.col("shingles").alias("s"))
    n = F.size("s")
    about = rows.join(pivot, "main").join(own, "id").select(
        "main", "id", n.alias("n"), F.array_except("s", "p").alias("r"), F.array_sort(F.array_intersect("s", "p")).alias("c")
    )
    size = F.col("n").cast("long")
    least, most = F.ceil(size * percent / 100 - F.lit(1e-9)), F.floor(size * 100 / percent + F.lit(1e-9))
    about = written(about.withColumn("least", least).withColumn("most", most).withColumn("reach", F.col("n") - F.col("least") + 1))
    outside = written(about.select("main", "id", F.explode("r").alias("e")))
    often = outside.groupBy("main", "e").agg(F.count("*").alias("f"))
    order = Window.partitionBy("main", "id").orderBy("f", "e")
    outside = outside.join(written(often.where("f > 1")), ["main", "e"], "left").select("main", "id", "e", F.coalesce("f", F.lit(1)).alias("f"))
    outside = outside.withColumn("at", F.row_number().over(order) - 1).where("f > 1")
    inside = about.where(F.size("r") < F.col("reach")).select("main", "id", F.size("r").alias("before"), F.posexplode(F.slice("c", F.lit(1), (F.col("reach") - F.size("r")).cast("int"))).alias("k", "e"))
    entry = outside.select("main", "id", "e", "at").unionByName(inside.select("main", "id", "e", (F.col("before") + F.col("k")).alias("at")))
    entry = entry.join(about.select("main", "id", "n", "least", "most"), ["main", "id"])
    entry = entry.withColumn("top", F.least("most", F.floor((F.col("n") - F.col("at")) * (100 + percent) / percent - F.col("n") + F.lit(1e-9)))).where("top >= least")
    return written(entry.select("main", "e", "id", "n", "least", "top"))


def _met(entry: DataFrame, rows: DataFrame, few: int | None = None) -> DataFrame:
    """Pairs (a, b) of ``rows`` (main, id, comp, minor) that meet at an ``entry``, of different ``comp``, one of them
    ``minor``: all of them, or with ``few`` (a round's number) only those with one row of the smallest and one of the
    largest ``comp`` of a meeting place, so that the pairs grow with the rows and not with the square of a family."""
    entry = entry.join(rows.select("main", "id", "comp", "minor"), ["main", "id"])
    size_class = lambda c: F.floor(F.log(c) / float(np.log(CLASS))).cast("int")
    left = entry.where("minor").select("main", "e", F.explode(F.sequence(size_class(F.col("least")), size_class(F.col("top")))).alias("class"), *(F.col(x).alias(x + "i") for x in ("id", "comp", "n", "top")))
    right = entry.select("main", "e", size_class(F.col("n")).alias("class"), *(F.col(x).alias(x + "j") for x in ("id", "comp", "n", "top")))
    if few is not None:
        one = F.struct("compj", F.xxhash64("idj", F.lit(few)), "idj", "nj", "topj")
        ends = right.groupBy("main", "e", "class").agg(F.min(one).alias("lo"), F.max(one).alias("hi"))
        right = ends.select("main", "e", "class", F.explode(F.array("lo", "hi")).alias("r")).select("main", "e", "class", "r.idj", "r.compj", "r.nj", "r.topj")
    met = left.join(right, ["main", "e", "class"]).where("compi <> compj and ni <= topj and nj <= topi")
    return met.select(F.least("idi", "idj").alias("a"), F.greatest("idi", "idj").alias("b")).distinct()


def _prefix_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rows`` (main, id, comp, minor) under one ``main``, of different ``comp``, one of them ``minor``,
    that can have 100 * intersection >= percent * union: no such pair is left out."""
    return _met(_entries(rows, sets, percent), rows)


def _relabelled(rows: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (main, id, comp, root) after ``links`` (a, b) between their ids, of those mains that still hold several
    components; and the links between components.  ``root`` is the component of ``main``."""
    label = rows.select("id", "comp").distinct()
    edges = links.join(label.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a").join(label.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
    edges = written(edges.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    merged = written(components(edges))
    to = lambda c: merged.select(F.col("id").alias(c), F.col("comp").alias("to"))
    for c in ("comp", "root"):
        rows = rows.join(to(c), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
    rows = written(rows.select("main", "id", "comp", "root"))
    open_ = rows.where("comp <> root").select("main").distinct()
    return written(rows.join(open_, "main", "left_semi")), edges


def _apart_links(rows: DataFrame, sets: DataFrame, percent: int, tried: DataFrame) -> DataFrame:
    """Links (a, b) between the components of ``rows`` (main, id, comp), enough to join all that confirmed pairs join;
    ``tried`` pairs are known.

    A family whose copies missed their leader would meet the rest of its component as all pairs.  Rounds of few pairs a
    row link most of it first, each with other partners; only rows still in different components meet in full.
    """
    entry = _entries(rows, sets, percent)
    rows = written(rows.select("main", "id", "comp", F.col("main").alias("root")))
    minor = lambda r: r.withColumn("minor", F.col("comp") != F.col("root"))
    edges = []
    for few in range(ROUNDS):
        pairs = written(_met(entry, minor(rows), few).join(tried, ["a", "b"], "left_anti"))
        links = written(_verified(pairs, sets, percent))
        if links.isEmpty():
            break
        tried = tried.unionByName(pairs)
        rows, new = _relabelled(rows, links)
        edges.append(new)
    last = written(_met(entry, minor(rows)).join(tried, ["a", "b"], "left_anti"))
    label = rows.select("id", "comp").distinct()
    links = _verified(last, sets, percent)
    links = links.join(label.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a").join(label.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
    return reduce(DataFrame.unionByName, edges, links.select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()


def link_groups(docs: DataFrame, base: DataFrame, to_sets: Callable, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept from documents and their sketches (see ``sketch_batch``).

    Equal sets collapse first; a bucket is linked through its smallest member; only what that leaves apart is compared
    further, across components, so a huge group of copies never becomes all its pairs.
    """
    keys = ["set_a", "set_b", "n_shingles"]
    equal = written(base.where("n_shingles > 0 and doc_id is not null").groupBy(*keys).agg(F.min("doc_id").alias("rep")))
    member = written(
        base.join(equal, keys, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"), F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands"))
    )
    entry = member.where("bands is not null").select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    lead = written(entry.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key", "lo"))
    bucket = written(entry.join(lead, "key").select("key", "lo", "id"))

    ids = bucket.select("id").distinct()
    sets = written(docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(to_sets, "id long, shingles array<long>"))

    # each member against the smallest leader it met: a forest, so parents are enough to label it
    first = bucket.where("id <> lo").groupBy("id").agg(F.min("lo").alias("a")).select("a", F.col("id").alias("b"))
    label = jump(written(_verified(first, sets, percent).select(F.col("b").alias("id"), F.col("a").alias("comp"))))

    # what the leaders left apart: rows outside a bucket's largest component, against the rest of that bucket
    rows = written(bucket.join(label, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp")))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rows = written(rows.join(written(mixed), "key", "left_semi"))
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = written(sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m")).select("key", F.col("m.comp").alias("main")))
    rows = written(rows.join(main, "key"))
    rows = written(rows.select("main", "id", "comp").distinct())
    more = written(_apart_links(rows, sets, percent, written(first)))
    merged = components(more).select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    whole = label.select("id", "comp").unionByName(merged.select(F.col("comp").alias("id"), F.col("comp"))).groupBy("id").agg(F.min("comp").alias("comp"))
    top = written(whole.join(merged, "comp", "left").select(F.col("id").alias("rep"), F.least(F.coalesce("top", "comp"), "comp").alias("top")))
    out = member.select("doc_id", "n_shingles", "rep").join(top, "rep", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("top", "rep").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


