"""Connected components of an edge table by star contraction (large and small stars).

Each round groups edges by node, links neighbours to the group's least node and
writes the result to the shared folder. The least node of a group is a mergeable
minimum; the join that hands it to the group's edges reads stored tables, so
adaptive execution can split a node that holds most of the edges. Only three
totals of the edge table come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import freeze


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))
        ).first()
    )


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (two columns of longs): root is the
    least node of its component. Nodes without an edge are not listed."""
    a, b = edges.columns
    now = freeze(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges"
    )
    before = _state(now)
    while True:
        now = freeze(_small(_large(now).filter("u != v").distinct()).filter("u != v").distinct(), "edges")
        state = _state(now)
        if state == before:
            break
        before = state
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
