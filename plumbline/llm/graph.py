"""Connected components over an edge table, by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is two
grouped minima and two equi-joins, so no component is ever held by one task. Hubs make skewed
join keys, which adaptive execution splits; the minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    # written before it is joined: two plain shuffles are what adaptive execution can split at a hub
    least = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """True if every node hangs on one root and no root hangs on another."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    grouped = ends.groupBy("n").agg(F.sum("child").alias("c"), F.max("root").alias("r"))
    return grouped.where("c > 1 or (c = 1 and r = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: any two columns of non-null long ids. Returns (node, component) for every node
    that isn't the smallest of its component; component is that smallest id. Self-loops and
    repeated edges don't matter; an empty table gives an empty one.
    """
    x, y = (F.col(c) for c in edges.columns[:2])
    now = cut(edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where("a <> b").distinct())
    while not _is_stars(now):
        now = cut(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
