"""Sensors, interaction distances and one-dimensional clustering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.asof import asof
from eventloom.operators.lookups import latest_reading
from eventloom.operators.ordered import islands

# Farthest interaction looked at (crossings); largest gap (cm), smallest
# gap error and largest gap in errors within a cluster.
REACH = 90
GAP, SMALLEST_ERROR, GAP_SIGMAS = 0.1, 1e-6, 999999.0


def clamped_time(t: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """(time within the sensor's range, whether it was inside)."""
    return F.greatest(F.least(t, end), start), (t >= start) & (t <= end)


def sensor_value(
    requests: DataFrame, readings: DataFrame, ranges: DataFrame, keys: Sequence[str], block_width: float
) -> DataFrame:
    """Last reading at the (clamped) time ``t`` of each request, null before the first.

    ``ranges`` has ``start`` and ``end`` per sensor; ``inside`` tells if t was within. However many requests are
    moved to an end of the range, each end is looked up once.
    """
    edges = ranges.select(*keys, F.explode(F.array("start", "end")).alias("_edge")).where("_edge IS NOT NULL").distinct()
    looked_up = latest_reading(edges, readings, keys, F.col("_edge"), F.col("t"), block_width)
    values = looked_up.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_edge", F.col("match.reading").alias("value")))).alias("_values")
    )
    at, inside = clamped_time(F.col("t"), F.col("start"), F.col("end"))
    # one row per sensor: broadcast, so that the requests of a sensor stay spread over all tasks
    ends = F.broadcast(ranges.join(values, list(keys), "left"))
    df = requests.join(ends, list(keys)).withColumns({"_at": at, "inside": inside})
    helpers = ["_at", "start", "end", "_values"]
    moved = (F.col("_at") == F.col("start")) | (F.col("_at") == F.col("end"))
    at_edge = df.where(moved).withColumn("value", F.element_at("_values", F.col("_at"))).drop(*helpers)
    within = df.where(~F.coalesce(moved, F.lit(False))).drop("_values")
    found = latest_reading(within, readings, keys, F.col("_at"), F.col("t"), block_width)
    found = found.withColumn("value", F.col("match.reading")).drop("match", *helpers)
    return at_edge.unionByName(found)


def resampled(
    readings: DataFrame, ranges: DataFrame, keys: Sequence[str], n: int, block_width: float
) -> DataFrame:
    """Each sensor at n equal steps from its start: ``step``, ``t`` and ``value``."""
    steps = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("step"))
    width = (F.col("end") - F.col("start")) / n
    grid = steps.withColumn("t", F.col("start") + F.col("step") * width).drop("start", "end")
    found = latest_reading(grid, readings, keys, F.col("t"), F.col("t"), block_width)
    return found.withColumn("value", F.col("match.reading")).drop("match")


def closest_interactions(
    events: DataFrame, interactions: DataFrame, keys: Sequence[str], at: str, block_width: int, gaps: Mapping[str, int],
    reach: int = REACH,
) -> DataFrame:
    """For each name and gap, the distance to the nearest interaction other than the event's own crossing.

    Looks up to ``reach`` crossings back, and ahead from the gap + 1 on; 0 if there is none. One as-of join back for
    all gaps and one ahead for each, so a crowded key forms no pairs.
    """
    marks = interactions.select(*keys, F.col(at).alias("_mark"))
    found = asof(events, marks, keys, F.col(at) - 1, F.col("_mark"), block_width, match="_behind")
    back = F.col(at) - F.col("_behind._mark")
    nearest = {}
    for i, (name, gap) in enumerate(gaps.items()):
        found = asof(
            found, marks, keys, F.col(at) + 1 + gap, F.col("_mark"), block_width, direction="forward", match=f"_ahead{i}"
        )
        ahead = F.col(f"_ahead{i}._mark") - F.col(at)
        closest = F.least(F.when(back <= reach, back), F.when(ahead <= reach, ahead))
        nearest[name] = F.coalesce(closest, F.lit(0).cast("bigint"))
    return found.withColumns(nearest).drop("_behind", *[f"_ahead{i}" for i in range(len(gaps))])


def closest_interaction(
    events: DataFrame, interactions: DataFrame, keys: Sequence[str], at: str, block_width: int, gap: int = 0,
    reach: int = REACH,
) -> DataFrame:
    """The distance ``closest`` for one gap."""
    return closest_interactions(events, interactions, keys, at, block_width, {"closest": gap}, reach)


def farthest_interaction(
    events: DataFrame, interactions: DataFrame, keys: Sequence[str], at: str, block_width: int, reach: int = REACH
) -> DataFrame:
    """Distance ``farthest`` to the outermost interaction within ``reach`` on either side."""
    marks = interactions.select(*keys, F.col(at).alias("_mark"))
    first = asof(
        events, marks, keys, F.col(at) - reach, F.col("_mark"), block_width, direction="forward", match="_first"
    )
    both = asof(first, marks, keys, F.col(at) + reach, F.col("_mark"), block_width, match="_last")
    back, ahead = F.col(at) - F.col("_first._mark"), F.col("_last._mark") - F.col(at)
    outermost = F.greatest(F.when(back > 0, back), F.when(ahead > 0, ahead))
    return both.withColumn("farthest", F.coalesce(outermost, F.lit(0).cast("bigint"))).drop("_first", "_last")


def gap_clusters(
    df: DataFrame, keys: Sequence[str], z: str, error2: str, tie: Sequence[str], block_width: float,
    gap: float = GAP, sigmas: float = GAP_SIGMAS,
) -> DataFrame:
    """Numbers clusters of neighbouring points along ``z``.

    A new one starts where the distance to the previous point exceeds ``gap``, or
    ``sigmas`` times its error.
    """
    def starts() -> Column:
        distance = F.col(z) - F.col("_prev_z")
        error = F.greatest(F.sqrt(F.col(error2) + F.col("_prev_e2")), F.lit(SMALLEST_ERROR))
        return (distance > gap) | (distance / error > sigmas)

    return islands(
        df,
        keys,
        F.floor(F.col(z) / block_width),
        [z, *tie],
        {"z": F.col(z), "e2": F.col(error2)},
        starts,
        uses=[z, error2],
        name="cluster",
    )
