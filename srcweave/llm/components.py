"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); component is the smallest node reachable.

    Each round is written to the shared folder, and only pairs of ids move.
    Smallest neighbours are found with partial aggregation, so a node with very
    many links is no hot group.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    current, n = scratch.stage(pairs, f"{name}-0"), 0
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        pairs = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct()
        following = scratch.stage(pairs, f"{name}-{n + 1}")
        scratch.drop(f"{name}-{n}")
        current, n = following, n + 1
        after = _state(current)
        if after == state:
            break
        state = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
