"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Size and an order-free checksum of an edge set (one small row)."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``); root: the least node reachable.

    Each round links every node to the least of its neighbourhood and ends when
    a round changes nothing.  All steps are aggregates with partial combine and
    equi-joins, so a node with very many neighbours is split like any skewed
    join; the edges never come to the driver.
    """
    edges = stored(edges.where("a != b").select("a", "b").distinct(), "edges")
    seen = _mark(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
