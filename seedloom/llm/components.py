"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.session import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """``id, component_id``: the smallest id reachable; ids without an edge are left out.

    Edges stay a table. Minima are combined before each shuffle and a node with very many
    neighbours is only the key of a join, which adaptive execution splits. Rounds grow with
    the logarithm of the longest path; each is cut by a checkpoint.
    """
    first, second = F.col(one), F.col(other)
    edges = edges.select(F.greatest(first, second).alias("hi"), F.least(first, second).alias("lo"))
    edges = cut_lineage(edges.filter("hi <> lo").distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = cut_lineage(small.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct())
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).unionAll(
        roots.select(F.col("lo").alias("id"), F.col("lo").alias("component_id"))
    )
