"""Connected components of links between whole numbers, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node that has a link, with the smallest node it is connected to.

    Alternates linking each node's larger neighbours, then its smaller ones, to its smallest neighbour,
    until every node hangs on one root: the number of rounds is logarithmic, a round is two aggregations, and
    a node with very many neighbours only passes on its smallest one (joined by key, never collected).
    """
    edges = stage(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while True:
        # stars: a node has one smaller neighbour, and that has none
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("up")))
        ends = ends.groupBy("node").agg(F.min("up").alias("lo"), F.max("up").alias("hi"), F.max(F.col("up").isNull()).alias("root"))
        if ends.where("lo < hi or (lo is not null and root)").limit(1).count() == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours go to the smallest of the neighbourhood
        down = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # then each node and its smaller neighbours go to the smallest of those
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            low.select("u", F.col("m").alias("v")))
        edges = stage(small.distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
