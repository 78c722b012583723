"""As-of joins: the latest (or next) right row at a left row's time.

Left and right rows are put into one ordered stream per key and the latest right
row is carried forward with ``ordered.blocked``.  The work is one shuffle of both
inputs; no pairs are formed, and a hot key is spread over its time blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import blocked


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: Column,
    right_time: Column,
    block_width: float,
    *,
    direction: str = "backward",
    strict: bool = False,
    right_order: Sequence[str] = (),
    match: str = "match",
) -> DataFrame:
    """Every left row with a struct ``match`` of the right row, null if none.

    ``backward`` takes the latest right row with time <= the left time (< when
    ``strict``), ``forward`` the first with time >= (>).  Right rows of equal time
    are ranked by the numeric ``right_order``: backward takes the highest, forward the lowest.
    The times must be of one numeric type; ``block_width`` is in their unit.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction}")
    keys, right_order = list(keys), list(right_order)
    # forward is backward with time (and rank) running the other way
    sign = 1 if direction == "backward" else -1
    # where times are equal a left row sorts after the right rows unless strict
    left_side, right_side = (0, 1) if strict else (1, 0)
    ranked = right.select(*[(sign * F.col(c)).alias(c) for c in right_order])
    tie_type = [f.dataType for f in ranked.schema]
    stream = left.select(
        *keys,
        (sign * left_time).alias("_t"),
        F.lit(left_side).alias("_side"),
        *[F.lit(None).cast(t).alias(f"_o{i}") for i, t in enumerate(tie_type)],
        F.struct(*left.columns).alias("_left"),
        F.lit(None).cast(right.select(F.struct(*right.columns).alias("s")).schema["s"].dataType).alias("_right"),
    ).unionByName(
        right.select(
            *keys,
            (sign * right_time).alias("_t"),
            F.lit(right_side).alias("_side"),
            *[(sign * F.col(c)).alias(f"_o{i}") for i, c in enumerate(right_order)],
            F.lit(None).cast(left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType).alias("_left"),
            F.struct(*right.columns).alias("_right"),
        )
    )
    order = ["_t", "_side", *[f"_o{i}" for i in range(len(right_order))]]
    stream = blocked(
        stream, keys, F.floor(F.col("_t") / F.lit(block_width)), order, last={match: F.col("_right")}
    )
    return stream.where(F.col("_left").isNotNull()).select("_left.*", match)


def nearest_record(
    left: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    left_time: Column,
    record_time: Column,
    block_width: float,
    record_order: Sequence[str] = (),
) -> DataFrame:
    """Bracketing records of a left row: structs ``lower`` and ``upper``.

    ``lower`` is the latest record at or before the left time, ``upper`` the one
    following it.  Both are null before the first record and after the last one; a
    left row exactly on the last record keeps ``lower`` and has no ``upper``.
    """
    names = records.columns
    timed = records.withColumn("_rt", record_time)
    linked = blocked(
        timed,
        keys,
        F.floor(F.col("_rt") / F.lit(block_width)),
        ["_rt", *record_order],
        lead={"upper": F.struct(*names)},
    )
    joined = asof(
        left.withColumn("_lt", left_time),
        linked,
        keys,
        F.col("_lt"),
        F.col("_rt"),
        block_width,
        right_order=record_order,
    )
    inside = F.col("match.upper").isNotNull() | (F.col("match._rt") == F.col("_lt"))
    lower = F.when(inside, F.struct(*[F.col(f"match.{n}").alias(n) for n in names]))
    return joined.select(*left.columns, lower.alias("lower"), F.when(inside, F.col("match.upper")).alias("upper"))
