"""Time-series lookups built on the as-of join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.asof import asof
from eventloom.operators.ordered import blocked, numbered


def valid_record(
    left: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    left_time: Column,
    record_time: Column,
    block_width: float,
    tolerance: float,
    match: str = "match",
) -> DataFrame:
    """The last record more than ``tolerance`` before the time, else the key's first one."""
    timed = records.withColumn("_rt", record_time)
    names = records.columns
    found = asof(
        left.withColumn("_lt", left_time - tolerance), timed, keys, F.col("_lt"), F.col("_rt"), block_width, strict=True
    )
    first = timed.groupBy(*keys).agg(F.min_by(F.struct(*names), "_rt").alias("_first"))
    found = found.join(first, list(keys), "left")
    held = F.when(F.col("match").isNotNull(), F.struct(*[F.col(f"match.{n}").alias(n) for n in names]))
    return found.select(*left.columns, F.coalesce(held, F.col("_first")).alias(match))


def latest_reading(
    left: DataFrame, readings: DataFrame, keys: Sequence[str], left_time: Column, reading_time: Column,
    block_width: float,
) -> DataFrame:
    """The last reading at or before the time, null before the first one."""
    return asof(left, readings, keys, left_time, reading_time, block_width)


def within_tolerance(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: Column, right_time: Column,
    block_width: float, tolerance: float,
) -> DataFrame:
    """The earliest right row within +- tolerance of each left row, as ``match``."""
    timed = right.withColumn("_rt", right_time)
    found = asof(
        left.withColumn("_lt", left_time),
        timed,
        keys,
        F.col("_lt") - tolerance,
        F.col("_rt"),
        block_width,
        direction="forward",
    )
    near = F.col("match._rt") - F.col("_lt") <= tolerance
    match = F.when(near, F.struct(*[F.col(f"match.{n}").alias(n) for n in right.columns]))
    return found.select(*left.columns, match.alias("match"))


def window_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], lo: Column, hi: Column, right_time: Column,
    right_order: Sequence[str], block_width: float, flags: Mapping[str, Column],
) -> DataFrame:
    """How many right rows with each flag lie in ``lo <= time <= hi`` of a left row.

    The difference of two running counts, so no pair is ever formed.
    """
    timed = right.withColumn("_rt", right_time)
    counted = blocked(
        timed,
        keys,
        F.floor(F.col("_rt") / F.lit(block_width)),
        ["_rt", *right_order],
        running={f"_n_{n}": c.cast("bigint") for n, c in flags.items()},
    ).select(*keys, "_rt", *right_order, *[f"_n_{n}" for n in flags])
    upto = asof(left.withColumn("_hi", hi), counted, keys, F.col("_hi"), F.col("_rt"), block_width,
                right_order=right_order, match="_upto")
    both = asof(upto.withColumn("_lo", lo), counted, keys, F.col("_lo"), F.col("_rt"), block_width,
                strict=True, right_order=right_order, match="_before")
    zero = F.lit(0).cast("bigint")
    counts = [
        (F.coalesce(F.col(f"_upto._n_{n}"), zero) - F.coalesce(F.col(f"_before._n_{n}"), zero)).alias(n)
        for n in flags
    ]
    return both.select(*left.columns, *counts)


def positions(records: DataFrame, keys: Sequence[str], time: Column, order: Sequence[str], block_width: float) -> DataFrame:
    """Records with their ``position`` (from 1) in time within the key, and their time as ``_rt``."""
    timed = records.withColumn("_rt", time)
    return numbered(timed, keys, F.floor(F.col("_rt") / F.lit(block_width)), ["_rt", *order], name="position")


def window_positions(
    left: DataFrame, placed: DataFrame, keys: Sequence[str], lo: Column, hi: Column, block_width: float
) -> DataFrame:
    """Each left row with the ``first`` and ``last`` position of the records in ``lo <= time <= hi``; no pair is formed.

    ``placed`` comes from `positions`. Without records in the window ``last`` is ``first`` - 1.
    """
    marks = placed.select(*keys, "_rt", "position")
    upto = asof(left.withColumn("_hi", hi), marks, keys, F.col("_hi"), F.col("_rt"), block_width,
                right_order=["position"], match="_upto")
    both = asof(upto.withColumn("_lo", lo), marks, keys, F.col("_lo"), F.col("_rt"), block_width,
                strict=True, right_order=["position"], match="_before")
    zero = F.lit(0).cast("bigint")
    before, last = F.coalesce("_before.position", zero), F.coalesce("_upto.position", zero)
    return both.select(*left.columns, (before + 1).alias("first"), F.greatest(last, before).alias("last"))


def at_positions(found: DataFrame, placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The records themselves, one row per (row of `window_positions`, position between its first and last)."""
    some = found.where("last >= first").withColumn("position", F.explode(F.sequence("first", "last")))
    return some.drop("first", "last").join(placed.drop("_rt"), [*keys, "position"])


def interaction_wanted(int1: Column, int2: Column, want1: int, want2: int) -> Column:
    """Whether an interaction record matches; 1 set, 0 not set, -1 ignored, 0/0 never."""
    if want1 == 0 and want2 == 0:
        return F.lit(False)
    wanted = F.lit(True)
    for flag, want in ((int1, want1), (int2, want2)):
        if want >= 0:
            wanted = wanted & (flag if want else ~flag)
    return wanted


def interpolated(lower: Column, upper: Column, base: Column, at: Column, name: str, time: str) -> Column:
    """Counter at ``at`` relative to the run's first record, whole counts.

    ``lower`` and ``upper`` are the bracketing records; null without an upper one.
    """
    slope = F.try_divide(
        (upper[name] - lower[name]).cast("double"), (upper[time] - lower[time]).cast("double")
    )
    step = (slope * (at - lower[time])).cast("bigint")
    return step + lower[name] - base


def last_by_prefix(classes: DataFrame, name: str, index: str, prefixes: Sequence[str]) -> DataFrame:
    """Highest class index whose name starts with each prefix."""
    hit = F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.col(name).startswith(p))
    return classes.select(F.explode(hit).alias("prefix"), index).groupBy("prefix").agg(F.max(index).alias(index))
