"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.tables import cut


def is_stars(edges: DataFrame) -> bool:
    """Whether every node is either the low end of its edges or the high end of one edge."""
    ends = edges.select(F.col("low").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.select(F.col("high").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("high"))
    )
    return ends.groupBy("n").agg(F.max("low").alias("low"), F.sum("high").alias("high")).where("low + high > 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component's name is its smallest node.

    Large star: every node sends its larger neighbours to the smallest node near it. Small star: the same
    for its smaller neighbours and itself. Repeated until there is a star for each component. Smallest neighbours come from aggregations that combine before the shuffle; the joins read
    written tables, so a node with very many edges is split by adaptive execution. Self loops and nulls are
    ignored, repeated edges count once; an empty table gives no rows.
    """
    now = cut(
        edges.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "edges"
    )
    while not is_stars(now):
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        nearest = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "nearest")
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        large = cut(large, "large")
        least = cut(large.groupBy("high").agg(F.min("low").alias("m")), "least")
        small = large.join(least, "high")
        now = cut(
            small.select("high", F.col("m").alias("low"))
            .unionByName(small.where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low")))
            .distinct(),
            "edges",
        )
    roots = now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
