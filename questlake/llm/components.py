"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import written


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Hooks the neighbours of each node that are larger (or smaller) than it to its least neighbour."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hooked = pairs.where("v > u" if larger else "v < u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        hooked = hooked.union(least.select("u", F.col("m").alias("v")))
    return hooked.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``u`` and ``v``); a component is named
    by its least node.

    Stars of larger and of smaller neighbours alternate until nothing moves, which takes about the
    logarithm of the longest path in rounds. Each round is a few joins over at most as many rows as
    there are links, and is written, so no round depends on the tasks of earlier ones.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "links")
    state = None
    while True:
        edges = written(_star(_neighbours(_star(_neighbours(edges), True)).where("v < u"), False), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == state:
            break
        state = now
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.union(edges.select(F.col("v"), F.col("v")).distinct())
