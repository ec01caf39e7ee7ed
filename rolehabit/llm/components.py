"""Connected components of a graph of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolehabit.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its smallest node.

    Every round hangs neighbours of a node on the smallest of them, once the larger
    ones and once the smaller ones, until the graph is a set of stars.  A node's
    neighbours are never gathered: their minimum is a partial aggregate, joined back,
    where adaptive execution may split a hub.  Loops, repeated and null links are
    dropped; no links give no rows.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _digest(edges)
    while before[0]:
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.where("a <> b").distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stored(smaller.distinct(), "links")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
