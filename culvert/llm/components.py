"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a`` and ``b``), where
    ``root`` is the smallest node that can be reached.

    Alternates two steps: each node's larger neighbours move to the smallest node
    that it knows, then its smaller ones do. A node with very many links costs one
    row per link and one pre-aggregated minimum, never a list of them. The links of
    a round are stored, so a round never recomputes the earlier ones. NULL ends and
    loops are left out; no links give no rows.
    """
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges, seen = stored(edges, "links"), None
    while True:
        edges = stored(_smaller(_larger(edges)), "links")
        now = tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _larger(edges: DataFrame) -> DataFrame:
    """Of each node's neighbours, the larger ones move to the smallest."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """Of each node's smaller neighbours, all move to the smallest, as it does itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m"))
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )
