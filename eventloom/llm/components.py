"""Connected components of an edge table by alternating star contraction.

Every step is a grouping and a join on the edge table, written to the shared folder;
nothing but whether the edges have become a forest of stars comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.session import stage_table


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node hangs on one other and none on a node that itself hangs."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
        F.struct(F.col("b").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")),
    )).alias("e")).select("e.*")
    nodes = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.filter("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of every node on the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage_table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs every node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage_table(down.groupBy("a").agg(F.min("b").alias("m")), "star")
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges(a, b)``: the smallest id it reaches.

    Edges may repeat; an edge from a node to itself and nulls are ignored.
    """
    edges = stage_table(edges.select("a", "b").filter("a != b").distinct(), "edges")
    moved = True
    while moved:
        for star in (_large_star, _small_star):
            edges = stage_table(star(edges).filter("a != b").distinct(), "edges")
        moved = not _is_forest(edges)
    hung = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stage_table(
        hung.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct(), "components"
    )
