"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch


def _stars(edges: DataFrame, keep: Column) -> DataFrame:
    """For each edge (u, v) that is kept: v linked to the smallest of u and u's neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node in edges (u, v); component is the smallest node reached.

    Each round is written, so lineage stays short. Hot nodes are combined before the shuffle of
    the minimum, and the join on them is one that adaptive execution splits. Starts jobs when
    called.
    """
    pairs = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = scratch.table(pairs.distinct(), "edges")
    before = None
    while (now := _state(pairs)) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, F.col("v") > F.col("u")).filter("u != v").distinct()
        large = scratch.table(large, "large")
        # here u > v in every edge; u itself is linked to its smallest neighbour as well
        least = large.groupBy("u").agg(F.min("v").alias("v"))
        small = _stars(large, F.col("v") != F.col("m")).unionByName(least)
        pairs = scratch.table(small.distinct(), "small")
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
