"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.shared import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (longs); the root is the component's smallest node.

    Every round hangs each node's larger neighbours, then its smaller ones, on its smallest neighbour, until
    all hang on their component's smallest. Minima are combined before the shuffle, so a hub is no hot key.
    Null ends and loops are ignored.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        links = written(small.distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
