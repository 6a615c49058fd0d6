"""Connected components by alternating large and small stars; the graph stays in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint); the component is its smallest node.

    A round links every larger neighbour to the smallest one, then every node's smaller neighbours to the smallest.
    Rounds end when the edges no longer change (two numbers come to the driver each round); each is checkpointed.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut_lineage(e)
    last = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        to_least = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(to_least.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def forest(a, b, n: int) -> list[tuple[int, int]]:
    """Edges among 0..n-1 that join different trees, in the order given."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a, b):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out
