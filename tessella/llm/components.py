"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def stars(pairs: DataFrame) -> bool:
    """Whether each leaf u has one centre v, and no centre is a leaf: another round would change nothing."""
    ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    by = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return not by.where("leaf + centre > 1").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): least node reachable, for every node of edges (a, b) of longs.

    Alternates large-star and small-star steps until the edges are stars. Least neighbours come from groupBy, so with
    partial aggregation, and are written down before they are joined: both sides of each join are then plain shuffles,
    of which Spark splits a hub's part, so that a hub's edges never meet in one task. A round's tables go with the next.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = materialize(pairs, "edges")
    while not stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least-neighbours")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "edges")
        discard(pairs, least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = materialize(small, "edges")
        discard(large, least)
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
