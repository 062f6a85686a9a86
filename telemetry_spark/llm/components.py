"""Connected components by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node of its neighbourhood,
small-star every smaller neighbour and the node itself; both keep the components, and together
they end in stars around each component's smallest node.  A hot node costs an aggregation with
map-side combining (its minimum) and a join that adaptive execution can split; no neighbourhood
is ever gathered.  The minima are written before they are joined: a join whose side is a fresh
aggregate on the same key keeps that key in one task, one over a stored table can be split.
Every half round is written to the shared folder too, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import materialise


def _store(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """Distinct edges (u > v), with what tells two sets of edges apart."""
    kept = edges.where("u <> v").distinct()
    stored, seen = materialise(kept, name, {
        "n": F.count(F.lit(1)), "x": F.bit_xor(F.xxhash64("u", "v")), "y": F.bit_xor(F.xxhash64("v", "u", F.lit(1)))})
    return stored, (seen["n"], seen["x"], seen["y"])


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least, _ = materialise(least, "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    least, _ = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge but the smallest of its component, with that
    smallest node.  ``a`` and ``b`` are integer columns; loops and repeated edges are ignored; no edges give no rows."""
    current, mark = _store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "edges")
    while mark[0]:
        large, _ = _store(large_star(current), "large-star")
        current, after = _store(small_star(large), "small-star")
        if after == mark:
            break
        mark = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
