"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b): each node's neighbours are linked to its smallest one instead.

    Minima come from a partial aggregate, so a hub isn't gathered; the join back is a sort-merge join of rows with one row a node,
    whose large partitions adaptive execution splits.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    moved = linked.filter("b > a") if large else linked
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str, rounds: int = 60) -> DataFrame:
    """``edges`` has (a, b); returns (node, component) for the nodes in edges, the component being its smallest node.

    Every round is written, so lineage stays short; it ends when a round changes nothing.
    """
    now = scratch.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    mark = None
    for i in range(1, rounds + 1):
        now = scratch.table(_star(_star(now, True), False), f"{name}-{i}")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if i > 1:
            scratch.drop(f"{name}-{i - 1}")
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    scratch.drop(f"{name}-0")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
