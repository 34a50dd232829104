"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One round: neighbours of each node go to its least neighbour. Minima are merged before the shuffle."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b") if larger else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("at"))
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("at", "m"))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b): root is the least node of its component.

    Large-star and small-star rounds, each written to the shared folder, until the edges are
    stars. Loops and repeated edges do no harm, null ends are left out; no edges, no rows.
    """
    now = keep(edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or not state[0]:
            break
        before = state
        now = keep(_stars(_stars(now, True), False), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select("root", "root").distinct())
