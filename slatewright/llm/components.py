"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a map-side-combined minimum per node and one join, so a node with very many
edges costs no more than its edges; its side of the join is split by adaptive execution.
The number of steps grows with the logarithm of the longest path. Nothing but the number of
edges changed comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatewright.session import written


def _smallest(both: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    return both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _checked(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and their number and a sum that tells two edge sets apart."""
    kept = written(edges, name)
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return kept, tuple(kept.agg(F.count("*"), total).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge.

    Null ends and loops are ignored, repeated edges count once; without edges the result is empty.
    """
    a, b = F.col(u), F.col(v)
    current = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    current, before = _checked(current.distinct(), "edges")
    while before[0]:
        # larger neighbours go to the smallest neighbour
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where(F.col("v") > F.col("u")).join(_smallest(both), "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        # smaller neighbours and the node itself go to the smallest neighbour
        large = written(_open(large), "large")
        low = _smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        current, after = _checked(_open(small), "small")
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _open(edges: DataFrame) -> DataFrame:
    """Larger end first, without loops and repeats."""
    far: Column = F.greatest("u", "v")
    return edges.where("u <> v").select(far.alias("u"), F.least("u", "v").alias("v")).distinct()
