"""Composed events: background embedding and label conventions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: labels of sub-event k start at k times this.
SUBEVENT_STEP = 10_000_000


def pair_up(
    signal: DataFrame, background: DataFrame, keys: Sequence[str], per_background: int, rank: str = "rank"
) -> DataFrame:
    """Each signal event with a background event that serves ``per_background`` signals in a row.

    Both sides are numbered from 1 within ``keys`` by the column ``rank``.
    """
    turns = signal.withColumn("_turn", F.floor((F.col(rank) - 1) / per_background) + 1).drop(rank)
    return turns.join(background.withColumnRenamed(rank, "_turn"), [*keys, "_turn"], "left").drop("_turn")


def with_offsets(subevents: DataFrame, event: Sequence[str]) -> DataFrame:
    """Offsets of primaries and secondaries: all primaries first, then all secondaries.

    The handful of sub-events of one event is ordered by ``sub``.
    """
    before = Window.partitionBy(*event).orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*event)
    secondaries = F.col("n_all") - F.col("n_prim")
    return subevents.withColumns(
        {
            "primary_offset": F.coalesce(F.sum("n_prim").over(before), F.lit(0)),
            "secondary_offset": F.sum("n_prim").over(whole) + F.coalesce(F.sum(secondaries).over(before), F.lit(0)),
        }
    )


def merged_labels(
    labels: DataFrame, subevents: DataFrame, event: Sequence[str], label: str, out: str = "merged"
) -> DataFrame:
    """Raw labels (sub-event number times step, plus index) as labels of the merged event.

    The sign of a label is kept; it marks a doubtful assignment.
    """
    size = F.abs(F.col(label))
    raw = labels.withColumns(
        {"sub": F.floor(size / SUBEVENT_STEP).cast(subevents.schema["sub"].dataType), "_idx": size % SUBEVENT_STEP}
    )
    offset = F.when(F.col("_idx") < F.col("n_prim"), F.col("primary_offset")).otherwise(
        F.col("secondary_offset") - F.col("n_prim")
    )
    joined = raw.join(subevents, [*event, "sub"])
    signed = F.when(F.col(label) < 0, -1).otherwise(1) * (F.col("_idx") + offset)
    return joined.withColumn(out, signed.cast("bigint")).drop("_idx", "n_prim", "n_all", "primary_offset", "secondary_offset")


def from_background(label: Column) -> Column:
    """True for a label that belongs to an embedded background event."""
    return F.abs(label) >= SUBEVENT_STEP
