"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.llm.common import stored
from objsync.operators.joins import split_join


def components(edges: DataFrame, purpose: str = "stars") -> DataFrame:
    """Map each node of ``edges`` (``a``, ``b``: longs) to the smallest node it can reach (``node``, ``root``).

    Each round points the neighbours of a node to the smallest of them, first the
    larger ones and then the smaller ones, until every node points to its root. The
    smallest neighbours are found by an aggregate and joined back in a join that
    splits, so a node with a third of all edges is spread. No edges give no rows.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, purpose)
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("low", "a").alias("root"))
        seen = split_join(both, least, ["a"])
        # A larger neighbour moves to the root; a node keeps an edge to its smallest neighbour.
        moved = seen.select(F.when(F.col("b") > F.col("a"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("root").alias("b"))
        moved = stored(moved.filter("a != b").distinct(), purpose)
        smallest = moved.groupBy("a").agg(F.min("b").alias("root"))
        pointed = split_join(moved, smallest, ["a"]).select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("root").alias("b")), F.struct(F.col("a").alias("a"), F.col("root").alias("b")),
        )).alias("e")).select("e.*")
        edges = stored(pointed.filter("a != b").distinct(), purpose)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge, to a node that has none to a smaller one."""
    sides = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    degrees = sides.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return degrees.filter("up > 1 or (up = 1 and down > 0)").isEmpty()
