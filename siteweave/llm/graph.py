"""Distributed connected components: alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: A node is a hub from this many edges on, and from so many that at most HUBS nodes can be hubs.
HUB_EDGES, HUBS = 64, 20_000


def _beside_least(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """The edges with ``m``, what ``least`` (u, m, n) has for their u. A hub's edges stay where they are, its m is sent to them."""
    many = max(HUB_EDGES, rows // HUBS)
    hubs = F.broadcast(least.where(F.col("n") > many).select("u", "m"))  # rows / many at most, so HUBS at most
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(least.select("u", "m"), "u")
    return edges.join(hubs, "u").unionByName(rest)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Links each node's larger neighbours to the least node around it. Minima combine before the shuffle."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _beside_least(both, least, 2 * rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Links each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _beside_least(edges, least, rows).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are separate stars: each node hangs on one other at most, and none that hangs has hangers."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    odd = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return odd.where("hangs > 1 or (hangs > 0 and holds > 0)").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node with an edge to another; component is the least node reachable.

    Nulls and self-loops are no edges; repeated edges and both directions are fine. Each round is a written
    table, so a lost executor repeats a round at most. No hub's edges are brought to one task.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    now = materialize(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(now):
            break
        rows = now.count()
        large = materialize(_large_star(now, rows), "edges")
        before, now = now, materialize(_small_star(large, rows), "edges")
        discard(before, large)
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
