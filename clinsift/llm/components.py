"""Connected components of an edge table, by alternating star contraction.

Every node is hung under the smallest node it can see: a large step hangs all larger
neighbours of a node under the smallest of its neighbours, a small step does the same with
the smaller ones.  Both keep the components and only shorten paths, so the edges end as
stars around the smallest node of each component.  Only minima per node are aggregated
(with map-side combine) and joined back; no component is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.llm.staging import staged


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (
        both.where("v > u")
        .join(low, "u")
        .where("v != m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """Edges point from the larger ``u`` to the smaller ``v``."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of all linked nodes; the component is its smallest node.

    Links of a node with itself or with a null are ignored.
    """
    edges = staged(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        edges = staged(_small(_large(edges)), "edges")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
