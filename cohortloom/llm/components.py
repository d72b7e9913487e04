"""Connected components of a graph of binary or other comparable vertices, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``vertex, label``: the smallest vertex of the component, for every vertex of ``links(a, b)`` but the smallest itself.

    Large star: the larger neighbours of a vertex are linked to its smallest neighbour; small star: a vertex and its
    smaller neighbours to the smallest of those. Both keep the components; repeated, all that is left is one star per
    component. ``scratch`` takes over the table that the result reads. No task sees the neighbours of a vertex together but through partial minima and plain joins.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    own = Scratch(links.sparkSession, "components")
    edges, before = own.written(edges, "edges"), None
    while True:
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.col("m").alias("u")).where(F.col("v") != F.col("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        linked = large.join(least, "v").where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = linked.union(least.select("v", F.col("m").alias("u"))).distinct()
        edges = own.written(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        own.drop(but_last=1)
        if now == before:
            if scratch is not None:
                scratch.paths += own.paths
            return edges.select(F.col("v").alias("vertex"), F.col("u").alias("label"))
        before = now
