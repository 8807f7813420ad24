"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(e: DataFrame):
    return e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(a, b)`` that is not a root itself.

    The root is the least node of a component. Each round is written to the shared folder, so a lost executor
    costs no more than the running round; only a count and a checksum come to the driver. Self-loops and
    repeated edges are ignored.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = _state(e)
    while True:
        e = stored(_small_star(_large_star(e)), "components")
        now = _state(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
