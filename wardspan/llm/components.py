"""Connected components of a distributed list of links.

Alternating large and small stars: every round links the neighbours of a node
to the least of them, by one aggregation and one join each, until every node
points to a root. Each round is a written table in the shared folder, so lineage stays
short; no node's neighbours are ever gathered, so a node with very many links
costs one partial minimum per task and a join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.sources.stage import Scratch


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node points to one root at most and no root points on."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star: every neighbour linked to the least around."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for each node in ``links`` (a, b): the least node reachable.

    Nodes are longs; the tables on the way, and the one returned, are in ``scratch``.
    Links to itself, repeated links and links with a null end
    are ignored; a node without another link is not returned.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.write(edges.distinct(), "links")
    while not _is_forest(edges):
        edges = scratch.write(_stars(edges), "stars")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
