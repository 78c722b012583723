"""Connected groups of objects within each event, from a table of links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.session import stored


def _mark(links: DataFrame) -> tuple:
    """Tells two sets of links apart."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64(*links.columns))).first())


def components(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``obj_id, root`` for every object of the links ``a, b``; the root is its group's smallest object.

    In each round every object hangs its larger neighbours on its smallest one, then its smaller
    ones, which halves the length of a chain or better: a chain of n takes about log2(n) rounds of
    two jobs.  Minima are combined before the shuffle, so an object with many links is no hot key.
    Null ends and loops are ignored.
    """
    keys = list(keys)
    links = links.where("a <> b").select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.distinct(), "links")
    before, now = None, _mark(links)
    while now != before:
        either = links.unionByName(links.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        least = either.groupBy(*keys, "a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        down = either.join(least, [*keys, "a"]).where("b > a")
        down = down.select(*keys, F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = down.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        rest = down.join(least, [*keys, "a"]).where("b <> m").select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(rest.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        before, now = now, _mark(links)
    hung = links.select(*keys, F.col("a").alias("obj_id"), F.col("b").alias("root"))
    return hung.unionByName(links.select(*keys, F.col("b").alias("obj_id"), F.col("b").alias("root")).distinct())
