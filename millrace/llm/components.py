"""Connected components of a graph given as rows, by alternating large and small stars.

Each step points every node to the smallest neighbour it knows; the edges left at the end are
a star around the smallest node of each component. Long chains shorten by half in each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v, once; larger or smaller neighbours move to the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    moved = both.join(low, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node in ``links``; a component is named by its smallest node.

    Links with a null end, or from a node to itself, are left out.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
