"""Connected components of a graph that is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable

#: rows of two or three numbers that are worth a task of their own
ROWS_PER_TASK = 200_000


def compact(df: DataFrame) -> DataFrame:
    """``df`` written once, in as many partitions as its rows are worth: small results make few small files."""
    done = durable(df)
    return done.coalesce(max(1, -(-done.count() // ROWS_PER_TASK)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b); a component is named by its smallest node.

    Alternates two steps until all components are stars: every node hands its larger neighbours to its
    smallest neighbour, then its smaller ones. Paths shorten by about half each time. Edges at one node
    are reduced to their minimum before any shuffle, and the joins are ones that adaptive execution can
    split at a hot node; every round is written to the shared folder.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    apart = edges.where(F.col("a") != F.col("b"))
    stars = compact(apart.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where((v > u) & (v != m)).select(v.alias("u"), m.alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), m.alias("v"))
        stars = compact(small.where(u != v).distinct())
    centres = stars.select(v.alias("node"), v.alias("component")).distinct()
    return stars.select(u.alias("node"), v.alias("component")).unionByName(centres)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one edge and is no smaller end."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where(F.col("up") + F.col("down") > 1).isEmpty()
