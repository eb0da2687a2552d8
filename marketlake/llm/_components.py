"""Connected components by alternating large-star and small-star steps.

Each step replaces the edges by edges to the smallest known neighbour; the number
of rounds grows with the logarithm of the graph's diameter, whatever the size of
a component.  Only minima are aggregated (map-side first), so a hub with any
number of edges costs its tasks a row each.  Every step is written to the shared
checkpoint folder.  The rounds end when the edges are stars, which an aggregate over
their ends tells; a further round, which would change nothing, costs ten shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import materialise, salted_lookup


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    up = both.filter(F.col("v") > F.col("u"))
    return (salted_lookup(up, least, ["u"], F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = _smallest(edges)
    moved = salted_lookup(edges, least, ["u"], F.col("v")).filter(F.col("v") > F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every upper end has one edge and is no lower end: its component is known."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not each.filter(F.col("up") + F.col("down") > 1).filter("up > 0").agg(F.count(F.lit(1))).first()[0]


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; the component is its smallest node."""
    now = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter(F.col("u") > F.col("v")).distinct(), "components")
    while not _are_stars(now):
        now = materialise(_small_star(materialise(_large_star(now), "components")), "components")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` (node, component) after further links (a, b): their stars take the place of all former links."""
    stars = components.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected(stars.union(links.select("a", "b")))
