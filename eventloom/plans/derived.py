"""Derived tables that need an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.plans.domain import table


def decays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One decay candidate per event: its first positive and negative leg and last leg.

    The legs are picked by partial aggregation, so an event of any length is fine.
    """
    legs = table(spark, sf_dir, "legs")
    key = F.col("obj_id")
    plus, minus = F.when(F.col("charge") > 0, key), F.when(F.col("charge") < 0, key)
    p = F.struct("px", "py", "pz")
    return (
        legs.groupBy("file_id", "event_idx")
        .agg(
            F.min_by(p, plus).alias("p"),
            F.min_by(p, minus).alias("n"),
            F.max_by(p, key).alias("b"),
            F.max_by(F.struct("sx", "sy", "sz"), key).alias("s"),
            F.min(plus).alias("pos_id"),
            F.min(minus).alias("neg_id"),
            F.max(key).alias("bach_id"),
        )
        .where("p IS NOT NULL AND n IS NOT NULL")
        .select(
            "file_id",
            "event_idx",
            *[F.col(f"{leg}.p{a}").alias(f"{leg}p{a}") for leg in "pnb" for a in "xyz"],
            "s.*",
            "pos_id",
            "neg_id",
            "bach_id",
        )
    )


def vector(prefix: str) -> tuple:
    """The three Columns ``<prefix>x``, ``<prefix>y`` and ``<prefix>z``."""
    return tuple(F.col(f"{prefix}{axis}") for axis in "xyz")
