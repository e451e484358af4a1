"""Connected components by repeated contraction, on DataFrames of links (a, b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import common


def contract(links: DataFrame) -> DataFrame | None:
    """(node, root) of every node that has a link; None without links.

    In each round every node moves to the neighbour (or itself) with the lowest
    keyed hash; links between the places that remain go on. The number of places
    falls by a constant factor in expectation, whatever the shape of the graph
    (long chains too). Groups are only ever aggregated, never collected.
    """
    edges = common.checkpoint(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        order = F.xxhash64(F.lit(turn), F.col("near")) if turn else F.col("near")
        both = edges.select(F.col("a").alias("at"), F.col("b").alias("near")).union(edges.select("b", "a"))
        both = both.union(both.select("at", F.col("at").alias("near")))
        places = common.checkpoint(both.groupBy("at").agg(F.min_by("near", F.struct(order, F.col("near"))).alias("to")))
        if roots is None:
            roots = places.select(F.col("at").alias("node"), F.col("to").alias("root"))
        else:
            moved = roots.join(places, roots["root"] == places["at"], "left")
            roots = common.checkpoint(moved.select("node", F.coalesce("to", "root").alias("root")))
        a, b = places.select(F.col("at").alias("a"), F.col("to").alias("to_a")), places.select(F.col("at").alias("b"), F.col("to").alias("to_b"))
        left = edges.join(a, "a").join(b, "b").filter("to_a <> to_b")
        edges = common.checkpoint(left.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
        turn += 1
    return roots


def components(links: DataFrame) -> DataFrame | None:
    """(node, component): the smallest node reachable, for every node that has a link."""
    roots = contract(links)
    if roots is None:
        return None
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return common.checkpoint(roots.join(least, "root").select("node", "component"))
