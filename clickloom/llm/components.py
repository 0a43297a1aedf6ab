"""Connected components by alternating large-star and small-star over stored edge tables.

A step groups the neighbours of each node around the least of them. Only a node's minimum is
aggregated, map-side first; neighbours are joined with it and never collected, so a hub with a
third of all edges is a skewed join and no large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..storage import Workspace


def _least(edges: DataFrame, work: Workspace) -> DataFrame:
    """``(u, least)``: the smallest of each node's neighbours."""
    return work.stage(edges.groupBy("u").agg(F.min("v").alias("least")), "star-least")


def _large_star(edges: DataFrame, work: Workspace) -> DataFrame:
    """Link each larger neighbour of a node with the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, work)
    larger = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return larger.select(
        F.col("v").alias("u"), F.least(F.col("least"), F.col("u")).alias("v")
    )


def _small_star(edges: DataFrame, work: Workspace) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, with the least of them."""
    least = _least(edges, work)
    smaller = edges.join(least, "u").filter(F.col("v") != F.col("least"))
    return smaller.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
        least.select("u", F.col("least").alias("v"))
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``(u, v)``: every linked node ``u`` but the least of its component, which is ``v``.

    ``links`` has the columns ``u`` and ``v``; direction, repetition and self links do not matter.
    The result is staged in ``work``.
    """
    directed = links.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = work.stage(directed.distinct(), "star-edges")
    mark = _mark(edges)
    while True:
        with Workspace(links.sparkSession) as own:
            large = own.stage(_large_star(edges, own).distinct(), "star-large")
            after = work.stage(_small_star(large, own).distinct(), "star-edges")
        new_mark = _mark(after)
        work.drop(edges)
        edges = after
        if new_mark == mark:
            return edges
        mark = new_mark
