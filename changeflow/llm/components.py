"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id that each id of ``(a, b)`` reaches; ids without links are left out.

    Alternating large-star and small-star rounds; each is two shuffles of the links, whose number
    never grows, and is written to the shared folder. A hub's neighbours are only ever reduced to
    their minimum, so no group is held in memory. Self links and repeated links do no harm.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "components")
    mark = None
    while True:
        # Large star: every neighbour above a node goes to the node's smallest neighbour.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = edges.select(F.col("b").alias("node"), F.col("a").alias("up")).join(lowest, F.col("node") == lowest["a"]).select(F.col("up").alias("a"), F.col("low").alias("b"))
        # Small star: a node and its lower neighbours go to the smallest of them.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        edges = written(small.where("a <> b").distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
