"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (columns a, b of one integer type, no nulls) with the smallest node they can reach: node, root.

    Large-star and small-star steps in turn: each hangs the neighbours of a node below the smallest of them, until every
    component is a star. Steps are joins and minima over edges, summed before the shuffle; each round is a stored table.
    Self-loops and repeated edges are allowed; a graph without edges has no nodes.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "edges")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.where("u <> v").distinct()
        # every edge now leads from a larger node u to a smaller v
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = staged(smaller.select("e.*").where("u <> v").distinct(), "edges")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
