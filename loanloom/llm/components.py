"""Connected components of a graph that is given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.session import stored


def _least(edges: DataFrame) -> DataFrame:
    """u, v with the smallest of u and its neighbours; folded in the tasks first."""
    ends = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return edges.join(ends, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, for every node of an edge (u, v).

    Rounds of large stars (each larger neighbour points to the smallest one) and small stars
    (each smaller neighbour does) until nothing changes; a node never has more edges than
    before, so no group is expanded into pairs. Loops and repeated edges do no harm.
    """
    edges = stored(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        large = _least(_both_ways(edges)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _least(large)
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
