"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, comp for every node of ``edges`` (two long columns).

    In each round every node points to the neighbour (or itself) that comes
    first in an order drawn anew, and edges become edges between the nodes
    pointed to; a constant share of the nodes goes in each round. A node with
    very many edges is a partial aggregation and a skewed equi-join, both of
    which Spark divides.
    """
    live = cut(_both(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))), "edges")
    maps: list[DataFrame] = []
    while not live.isEmpty():
        order = F.xxhash64(F.col("b"), F.lit(len(maps)))
        first = F.min_by("b", order)
        own = F.xxhash64(F.col("a"), F.lit(len(maps)))
        points = live.groupBy("a").agg(first.alias("b"), F.min(order).alias("o"))
        points = cut(points.select(F.col("a").alias("node"), F.when(own <= F.col("o"), F.col("a")).otherwise(F.col("b")).alias("to")), "points")
        maps.append(points)
        left = live.where("a < b").join(points.withColumnRenamed("to", "_a"), F.col("a") == F.col("node")).select("_a", "b")
        both = left.join(points.withColumnRenamed("to", "_b"), F.col("b") == F.col("node")).select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        live = cut(_both(both), "edges")
    if not maps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = maps[0].withColumnRenamed("to", "comp")
    for step in maps[1:]:
        after = step.select(F.col("node").alias("_n"), "to")
        out = out.join(after, F.col("comp") == F.col("_n"), "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return cut(out, "components")


def _both(edges: DataFrame) -> DataFrame:
    """The distinct edges between different nodes, in both directions."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    once = edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct()
    return once.union(once.select("b", "a"))
