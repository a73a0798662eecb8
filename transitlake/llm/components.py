"""Connected components of an edge table by alternating large-star and small-star steps; all state stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, small, staged


#: Rows of the table of least neighbours that are broadcast, 16 bytes each.
BROADCAST_ROWS = 500_000


def _stars(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """One large-star step, then one small-star step; every edge (a, b) has a > b.

    A hub can have a third of all nodes around it. The least neighbours are sums over them, and are written, so that the
    joins on the hub are broadcast, or between two plain shuffles whose large partitions Spark splits.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = small(staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), folder, f"{name}-least"), BROADCAST_ROWS)
    large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct(), folder, f"{name}-large")
    least = staged(large.groupBy("a").agg(F.min("b").alias("m")), folder, f"{name}-lower")
    inner = large.join(small(least, BROADCAST_ROWS), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return inner.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, folder: str, name: str, rounds: int = 50) -> DataFrame:
    """(node, root) for every node with an edge in ``edges`` (a, b); ``root`` is the least node of its component.

    Loops and repeated edges are ignored; an empty table gives an empty table. Each round is written to the shared folder,
    so that a lost executor costs no more than the round; the one before it goes.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = staged(edges, folder, f"{name}-0")
    # it has ended when every node has one edge and no node is both above and below
    for i in range(1, rounds + 1):
        tops = now.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if tops.where("n > 1").isEmpty() and now.join(tops.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        now = staged(_stars(now, folder, f"{name}-{i}"), folder, f"{name}-{i}")
        drop(now.sparkSession, f"{folder}/{name}-{i - 1}", *[f"{folder}/{name}-{i}-{part}" for part in ("least", "large", "lower")])
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", F.col("b").alias("root")).distinct())
