"""Connected components over link tables that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.scratch import written


def jump(parent: DataFrame) -> DataFrame:
    """(id, comp) forest with comp < id: every id with its root (pointer doubling: log(depth) rounds)."""
    while True:
        up = parent.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        moved = written(parent.join(up, "comp", "left").select("id", F.coalesce("next", "comp").alias("comp"), F.col("next").isNotNull().alias("moved")))
        parent = moved.select("id", "comp")
        if not moved.where("moved").take(1):
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over undirected edges (a, b), for every id on an edge.

    Each round takes the smallest label around every id and then the label's own label, so a path of length n needs
    about log(n) rounds; the minimum has a map-side part, so a hub costs one row a task.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")))
    while True:
        near = both.join(label.select(F.col("id").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        low = written(label.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "c").alias("comp")))
        up = low.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        after = written(low.join(up, "comp", "left").select("id", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp")))
        label = after.select("id", "comp")
        if not after.where("old <> comp").take(1):
            return label
