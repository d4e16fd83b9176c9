"""Connected components of an edge table by alternating star contractions, all of it distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import drop_staged, staged


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b; 64-bit integers).

    Each round points a node's larger neighbours, then its smaller ones, at the smallest it sees; the
    number of rounds grows with the logarithm of the longest path. Minima are combined before the
    shuffle and joined back, so a node with any number of neighbours needs no task of its own. Every
    round is a written table, which cuts the lineage and survives lost executors.
    """
    now = staged(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = staged(large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        after = staged(small.where("a <> b").distinct(), "stars")
        mark = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        for old in (now, large):
            drop_staged(old)
        now = after
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
