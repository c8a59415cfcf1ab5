"""Connected components of an edge table by alternating large stars and small stars; only a few numbers a round reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.shared import bounds, spread_join, written


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, link to the smallest of them. ``edges`` are a table (u, v), u > v."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "component-least")
    moved = spread_join(edges, least, ["u"], known=bounds(least)).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame | None:
    """Each node's larger neighbours link to the smallest of its neighbours and itself. None if all edges are stars already.

    They are if each node has one smaller neighbour at most and none if it has larger ones. ``edges`` are a table without repeats.
    """
    both = edges.select("u", "v", F.lit(0).alias("n")).union(edges.select(F.col("v").alias("u"), F.col("v"), F.lit(1).alias("n")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.sum("n").alias("n")).withColumnRenamed("u", "v"), "component-least")
    hubs = least.where("n > 0")
    total, most, fewest, leaves, between = least.agg(
        F.expr("coalesce(sum(n), 0)"), F.expr("coalesce(max(n), 0)"), F.expr("coalesce(min(n) FILTER (WHERE n > 0), 0)"),
        F.expr("count_if(m < v)"), F.expr("count_if(m < v AND n > 0)")).first()
    if not between and leaves == total:
        return None
    return spread_join(edges, hubs, ["v"], known=(total, most, fewest)).select("u", F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), two numbers of one type, a != b: root is the smallest node reachable.

    Both steps keep what is connected connected and never add edges, so dense groups shrink to a star in the first rounds;
    rounds grow with the logarithm of a component's width in practice. Minima are pre-aggregated before they are shuffled,
    a hub's edges meet its minimum by broadcast, and each round is written, so hubs and lost executors do no harm. The end
    is when the minima show nothing but stars.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "component-edges")
    while (larger := _large_star(now)) is not None:
        now = written(_small_star(written(larger, "component-stars")), "component-stars")
    own = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return own.union(now.select("v", "v").distinct())
