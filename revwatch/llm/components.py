"""Connected components by alternating large and small stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revwatch.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the least of itself and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
        least.select("a", F.col("m").alias("b"))
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is a component's least node.

    Each round is written to the shared folder, which also cuts the lineage; the rounds
    needed grow with the logarithm of the longest path. A hub's edges share one join key,
    which the adaptive join splits, and its least neighbour is pre-aggregated. Loops and
    repeated edges do no harm; null ends must not occur.
    """
    now = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    mark = _mark(now)
    while True:
        stars = _small_star(_large_star(now)).where(F.col("a") != F.col("b")).distinct()
        now = written(stars, "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionAll(roots)
