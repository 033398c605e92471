"""Connected components by alternating large and small stars, joins and minima only.

Each round is four small plans, the minima and the stars they make, large and small, since in one plan the
large stars would stand several times. Rounds end as soon as the edges are stars, which one aggregation tells: what already is one
needs no round. The joins are merged at every size, as edges grow with the input, so nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each node move to its least neighbour."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    # plain shuffles on both sides of the join, so that a node with many neighbours can be split
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    moved = both.filter("v > u").join(least.hint("merge"), "u")
    return moved.select(F.col("v").alias("high"), F.col("m").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Lesser neighbours of each node, and the node, move to the least of them."""
    least = written(edges.groupBy("high").agg(F.min("low").alias("m")), "least")
    moved = edges.join(least.hint("merge"), "high").filter("low <> m")
    return moved.select(F.col("low").alias("high"), F.col("m").alias("low")).unionByName(
        least.select("high", F.col("m").alias("low"))
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has either one neighbour, a lesser one, or only greater ones."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("above")).unionByName(
        edges.select(F.col("low").alias("node"), F.lit(0).alias("above"))
    )
    nodes = ends.groupBy("node").agg(F.sum("above").alias("above"), F.count("*").alias("n"))
    return nodes.agg(F.count_if((F.col("above") > 0) & (F.col("n") > 1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node that each node of edges (a, b) is linked with."""
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    edges = written(edges.filter("high <> low").distinct(), "edges")
    while not _are_stars(edges):
        stars = written(_large_star(edges).distinct(), "stars")
        edges = written(_small_star(stars).distinct(), "edges")
    roots = edges.select(F.col("low").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
