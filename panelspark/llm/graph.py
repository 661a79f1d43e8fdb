"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node moves to the node's smallest
    neighbour (or itself).  Small star: its smaller neighbours and itself do.
    The minimum per node is combined before the shuffle; the join on a hot node
    is an equi-join that adaptive execution may split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.withColumn("m", F.least("m", "u"))
    out = both.join(low, "u")
    if large:
        out = out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with a link; root is the smallest id it
    reaches.  Repeats the two stars, each round written out, until a round
    changes nothing; the number of rounds grows with the logarithm of the size."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col("u") != F.col("v")).distinct())
    edges = staged(edges, "edges")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = edges.agg(mark.alias("s")).first()[0]
    while before[0]:
        edges = staged(_star(_star(edges, True), False), "edges")
        after = edges.agg(mark.alias("s")).first()[0]
        if after == before:
            break
        before = after
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
