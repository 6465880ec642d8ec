"""Connected components by alternating large and small stars over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours of each node on the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    moved = both.join(least, F.col("a") == F.col("node"))
    if small:
        moved = moved.select(F.col("b").alias("x"), F.col("low").alias("y")).union(
            least.select(F.col("node").alias("x"), F.col("low").alias("y"))
        )
    else:
        moved = moved.where("b > a").select(F.col("b").alias("x"), F.col("low").alias("y"))
    return moved.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    ``edges`` has two columns of one orderable type. Null ends and loops are ignored. Each
    round is written to the shared folder; the loop ends when a round changes no edge. Edges
    never grow in number, and only two sums per round reach the driver.
    """
    first, second = edges.columns
    edges = edges.where(F.col(first) != F.col(second)).select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
    )
    edges, before = written(edges.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = tuple(now)
        edges = written(_star(_star(edges, small=False), small=True), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
