"""Accelerator records: bunch configurations, intensities, change-only series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.lookups import valid_record
from eventloom.operators.ordered import blocked

# Tolerance of record times (s), lead-in before and margin after a run (s),
# number of bunch slots, buckets per slot, slot offsets of the two beams and their
# change since 2015.
TOLERANCE = 0.9
LEAD_IN = 30 * 24 * 3600.0
MARGIN = 15 * 60.0
SLOTS = 3564
BUCKETS_PER_SLOT = 10
BEAM_OFFSETS = (346, 3019)
OFFSET_CHANGE = -2


def slot(bucket: Column, beam: int, since_2015: bool = True) -> Column:
    """Slot number of a bucket number; the sign of a bucket only marks it as interacting."""
    offset = BEAM_OFFSETS[beam] + (OFFSET_CHANGE if since_2015 else 0)
    return (F.floor(F.abs(bucket) / BUCKETS_PER_SLOT) + offset) % SLOTS


def interacting(first: DataFrame, second: DataFrame, keys: Sequence[str], block_width: float) -> DataFrame:
    """First-beam records with the bunches whose slot is also filled in the second beam.

    The second beam's record is the one valid at the first record's time.  Records
    have ``t`` and an array ``bunches`` of at most 3564 bucket numbers.
    """
    paired = valid_record(first, second, keys, F.col("t"), F.col("t"), block_width, TOLERANCE, match="_other")
    paired = paired.where(F.col("_other").isNotNull()).withColumn(
        "_slots", F.transform("_other.bunches", lambda b: slot(b, 1))
    )
    meets = F.filter("bunches", lambda b: F.array_contains("_slots", slot(b, 0)))
    return paired.withColumn("interacting", meets).drop("_other", "_slots")


def mean_intensity(
    intensities: DataFrame, configurations: DataFrame, masks: DataFrame | None, keys: Sequence[str], beam: int
) -> DataFrame:
    """Mean intensity per record of interacting and other bunches of a beam.

    ``intensities``: one array ``values`` per record; ``configurations``: one row per
    key with ``bunches`` (interacting ones negative); ``masks``: one row per key with
    the slots ``masked_both`` and ``masked_single`` to leave out.  Negative values are
    skipped and the sums start at 0.
    """
    joined = intensities.join(configurations, list(keys))
    joined = joined.join(masks, list(keys), "left") if masks is not None else joined
    pair = F.arrays_zip(F.col("bunches").alias("bunch"), F.col("values").alias("value"))

    def total(negative: bool, masked: str) -> Column:
        def counted(p: Column) -> Column:
            side = p["bunch"] < 0 if negative else p["bunch"] >= 0
            keep = side & (p["value"] >= 0)
            if masks is not None:
                keep = keep & ~F.coalesce(F.array_contains(masked, slot(p["bunch"], beam)), F.lit(False))
            return F.coalesce(keep, F.lit(False))

        return F.aggregate(F.filter(pair, counted), F.lit(0.0), lambda acc, p: acc + p["value"])

    return joined.groupBy(*keys).agg(
        (F.sum(total(True, "masked_both")) / F.count("*")).alias("colliding"),
        (F.sum(total(False, "masked_single")) / F.count("*")).alias("noncolliding"),
        F.count("*").alias("n_records"),
    )


def pilot_present(scheme: Column) -> Column:
    """Whether a filling scheme's name mentions a pilot bunch."""
    return F.lower(scheme).contains("wp")


def trimmed(values: Column) -> Column:
    """Array up to its first zero."""
    end = F.array_position(values, 0)
    return F.when(end > 0, F.slice(values, F.lit(1), (end - 1).cast("int"))).otherwise(values)


def changes_only(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: str) -> DataFrame:
    """Records whose value differs from the previous record's; a key's first one is kept."""
    lagged = {"_prev": F.col(value), "_has_prev": F.lit(True)}
    df = blocked(df, keys, block, order, lag=lagged)
    keep = F.col("_has_prev").isNull() | ~F.col(value).eqNullSafe(F.col("_prev"))
    return df.where(keep).drop("_prev", "_has_prev")


def run_window(
    records: DataFrame, windows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column
) -> DataFrame:
    """Records of each run window (``t_min``, ``t_max``; one per key), with lead-in and margin.

    Kept are the last record at or before the start, those within, and the first
    record after the end if it is at most 15 minutes late.  A key with no record
    between 30 days before its start and 15 minutes after its end has none.
    """
    df = records.join(windows, list(keys))
    near = F.col("t").between(F.col("t_min") - LEAD_IN, F.col("t_max") + MARGIN)
    useful = df.where(near).select(*keys).distinct()
    df = df.join(useful, list(keys), "left_semi")
    df = blocked(df, keys, block, order, lag={"_before": F.col("t")}, lead={"_after": F.col("t")})
    start = (F.col("t") <= F.col("t_min")) & (F.col("_after").isNull() | (F.col("_after") > F.col("t_min")))
    inside = (F.col("t") > F.col("t_min")) & (F.col("t") <= F.col("t_max"))
    late = (F.col("t") > F.col("t_max")) & (F.col("t") <= F.col("t_max") + MARGIN)
    first_late = late & (F.col("_before").isNull() | (F.col("_before") <= F.col("t_max")))
    return df.where(start | inside | first_late).drop("_before", "_after", "t_min", "t_max")


def per_bunch(
    values: DataFrame, configurations: DataFrame, keys: Sequence[str], block_width: float
) -> DataFrame:
    """Per-slot arrays re-indexed by the bunches of the configuration valid at their time.

    ``per_bunch[i]`` is the value in the slot of the i-th bunch, -1 if out of range.
    """
    joined = valid_record(
        values, configurations, keys, F.col("t"), F.col("t"), block_width, TOLERANCE, match="_conf"
    )
    picked = F.transform(
        F.col("_conf.bunches"),
        lambda b: F.coalesce(
            F.get(F.col("values"), F.floor(F.abs(b) / BUCKETS_PER_SLOT).cast("int")), F.lit(-1.0)
        ),
    )
    return joined.withColumn("per_bunch", picked).drop("_conf")
