"""Call stacks of a sampled profile: paths to the root by pointer doubling, counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, materialize


def paths(nodes: DataFrame, depth: int = 12) -> DataFrame:
    """(node, frames): the frames from each node towards the root, `depth` at most.

    A pass appends to each path the path of the node where it ends, so lengths double. A missing parent ends a path.
    """
    now = materialize(nodes.select("node", F.array("frame").alias("frames"), F.col("parent").alias("next")), "paths")
    reach = 1
    while reach < depth:
        other = now.select(F.col("node").alias("_node"), F.col("frames").alias("_frames"), F.col("next").alias("_next"))
        longer = now.join(other, F.col("next") == F.col("_node"), "left")
        after = materialize(longer.select("node", F.concat("frames", F.coalesce("_frames", F.array().cast("array<string>"))).alias("frames"), F.col("_next").alias("next")), "paths")
        discard(now)
        now, reach = after, reach * 2
    return now.select("node", F.slice("frames", 1, depth).alias("frames"))


def top_stacks(nodes: DataFrame, samples: DataFrame, n: int, shown: int = 6) -> DataFrame:
    """(stack, samples, share): the n most frequent stacks by their first frames, with percentages. Samples are counted by
    node before they meet the paths; samples of unknown nodes have an empty stack."""
    own = samples.groupBy("node").agg(F.count("*").alias("samples")).join(paths(nodes), "node", "left")
    stack = F.array_join(F.slice(F.coalesce("frames", F.array().cast("array<string>")), 1, shown), " < ")
    counted = own.groupBy(stack.alias("stack")).agg(F.sum("samples").alias("samples"))
    total = F.broadcast(counted.agg(F.sum("samples").alias("total")))  # one row
    return counted.join(total, F.lit(True)).select("stack", "samples", F.round(100 * F.col("samples") / F.col("total"), 1).alias("share")).orderBy(F.desc("samples"), "stack").limit(n)
