"""Robust location and scale: the contiguous window of sorted values with least variance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.ordered import blocked, joined_on
from eventloom.operators.ranges import range_join
from eventloom.session import stored

# Scale factors for window fractions 0.5, 0.525, ... 0.75.
FACTORS = (2.6477, 2.5092, 2.3826, 2.2662, 2.1587, 2.0589, 1.9660, 1.879, 1.7973, 1.7203, 1.6473)

#: Cells that a key's range of values is cut into, where only rows that may bound the best window are ranked.
CELLS = 4096


def scale_factor(h: Column, n: Column) -> Column:
    step = ((h / n - 0.5) * 40).cast("int")
    at = F.greatest(F.least(step, F.lit(len(FACTORS) - 1)), F.lit(0))
    return F.element_at(F.array(*[F.lit(f) for f in FACTORS]), at + 1)


def ranked_values(df: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Per key ``_n, _low, _avg, _std`` of its values, and every value ``_x`` with its position ``_rank`` (from 1) among the sorted values of its key.

    Also the values of the key ``_n``, its lowest ``_low``, the distance from it ``_d``, and sums ``_s1, _s2`` of the
    distances and their squares up to and including the row.

    The rows are dealt into ranges of equal size of (key, value, row), whatever the values' distribution and the keys'
    sizes; a value that many rows hold is split like any other stretch. What a range adds up to, the ranges after it
    start from.
    """
    keys = list(keys)
    plain = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_x"))
    rows = plain.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys, "_x", "_row")
    rows = stored(rows.withColumn("_range", F.spark_partition_id()), "ranges")
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_x").alias("_low"), F.avg("_x").alias("_avg"), F.stddev_samp("_x").alias("_std")
    )
    # measured from the lowest value, so that the sums of squares stay small
    rows = joined_on(rows, stats, keys).withColumn("_d", F.col("_x") - F.col("_low")).drop("_avg", "_std")
    sums = {"_rank": F.lit(1).cast("bigint"), "_s1": F.col("_d"), "_s2": F.col("_d") * F.col("_d")}
    return stats, blocked(rows, keys, F.col("_range"), ["_d", "_row"], running=sums).drop("_range", "_row")


_PICKED = "_cell long, _before long, _c1 double, _c2 double, _start boolean"


def _picked(keys: Sequence[str], median: bool):
    """Of one key's cells (at most CELLS rows) those whose rows may begin or end the window of least variance, or hold the median.

    A window that begins in a cell holds the same whole cells wherever in it it begins. The squares about their mean, and the least
    and greatest distance of its other values, bound its squares from both sides; where the lower bound
    is above another's upper bound, the best window does not begin.
    """

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("_cell", ignore_index=True)
        n, low, high = (cells[c].to_numpy() for c in ("_count", "_least", "_most"))
        upto, to1, to2 = n.cumsum(), cells["_d1"].cumsum().to_numpy(), cells["_d2"].cumsum().to_numpy()
        before, before1, before2 = (np.append(0, x[:-1]) for x in (upto, to1, to2))
        total, h = int(upto[-1]), int(cells["_h"].iloc[0])
        a = np.flatnonzero(before + 1 <= total - h)
        first = np.searchsorted(upto, before[a] + h)
        last = np.searchsorted(upto, np.minimum(upto[a], total - h) + h - 1)
        with np.errstate(all="ignore"):
            inner = np.maximum(before[first] - upto[a], 0)
            some = inner > 0
            sum1, sum2 = (np.where(some, x[first] - y[a], 0.0) for x, y in ((before1, to1), (before2, to2)))
            mean = np.where(some, sum1 / np.maximum(inner, 1), (low[a] + high[last]) / 2)
            squares = np.where(some, np.maximum(sum2 - sum1 * mean, 0), 0.0)
            others = h - inner
            # where the mean of the whole window may lie, and so how far the others are from it at least
            least, most = (sum1 + others * low[a]) / h, (sum1 + others * high[last]) / h
            near = np.maximum(np.minimum(least - high[a], low[first] - most), 0)
            far = np.maximum(mean - low[a], high[last] - mean)
            limit = np.min(squares + others * far * far, initial=np.inf) * (1 + 1e-6) + 1e-11 * to2[-1]
            # what is not a number is never left out
            kept = ~(squares + others * near * near > limit)
        start, wanted = np.zeros(len(n), bool), np.zeros(len(n) + 1, np.int64)
        start[a[kept]] = True
        np.add.at(wanted, first[kept], 1)
        np.add.at(wanted, last[kept] + 1, -1)
        used = start | (wanted.cumsum()[:-1] > 0)
        if median:
            used[np.searchsorted(upto, [(total + 1) // 2, (total + 2) // 2])] = True
        out = cells[[*keys, "_cell"]].assign(_before=before, _c1=before1, _c2=before2, _start=start)
        return out[used]

    return run


def ranked_candidates(
    df: DataFrame, keys: Sequence[str], value: str, wanted: Column, median: bool
) -> tuple[DataFrame, DataFrame]:
    """As :func:`ranked_values`, but of the values only those that the best window (or the median) may ask for.

    ``_start`` tells where a window may begin. Every value is counted in its cell, one of CELLS between
    its key's lowest and highest value; only the rows of few cells are sorted and kept. Values that crowd in
    few cells are ranked more often than needed, at worst all of them.
    """
    keys = list(keys)
    plain = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_x"))
    stats = plain.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"),
        F.avg("_x").alias("_avg"), F.stddev_samp("_x").alias("_std"),
    )
    stats = stored(stats.withColumn("_h", wanted.cast("bigint")), "spread")
    rows = joined_on(plain, F.broadcast(stats.select(*keys, "_low", "_high", "_h")), keys)
    span, d = F.col("_high") - F.col("_low"), F.col("_x") - F.col("_low")
    place = F.least(F.floor(d / span * CELLS), F.lit(CELLS - 1).cast("bigint"))
    rows = rows.withColumn("_cell", F.when((span > 0) & (span < float("inf")), place).otherwise(F.lit(0).cast("bigint")))
    d = d.cast("double")
    cells = rows.groupBy(*keys, "_h", "_cell").agg(
        F.count("*").alias("_count"), F.min(d).alias("_least"), F.max(d).alias("_most"), F.sum(d).alias("_d1"), F.sum(d * d).alias("_d2")
    )
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.select(*keys).schema.fields)
    picked = stored(cells.groupBy(*keys).applyInPandas(_picked(keys, median), f"{types}, {_PICKED}"), "picked")
    inside = joined_on(rows, F.broadcast(picked.select(*keys, "_cell", "_before")), [*keys, "_cell"]).where("_before IS NOT NULL")
    _, ranked = ranked_values(inside, [*keys, "_cell"], "_x")
    # from the cell's lowest value to the key's
    ranked = ranked.drop("_n").withColumnRenamed("_low", "_from")
    ranked = joined_on(joined_on(ranked, F.broadcast(picked), [*keys, "_cell"]), F.broadcast(stats.select(*keys, "_n", "_low")), keys)
    by, rank = F.col("_from") - F.col("_low"), F.col("_rank")
    ranked = ranked.select(
        *keys, "_x", "_n", "_low", "_start", (F.col("_d") + by).alias("_d"), (F.col("_before") + rank).alias("_rank"),
        (F.col("_c1") + F.col("_s1") + rank * by).alias("_s1"),
        (F.col("_c2") + F.col("_s2") + 2 * by * F.col("_s1") + rank * by * by).alias("_s2"),
    )
    return stats.drop("_h", "_high"), ranked


def location_and_scale(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    h: Column | None = None,
    external: float | None = None,
    median: bool = False,
    few_keys: bool = False,
) -> DataFrame:
    """``mean`` and ``sigma`` (and all values' ``median``, if asked for) of the h neighbouring values with the least variance, per key.

    ``h`` defaults to (n+2)/2, which also stands in for an ``h`` below two; of equal variances the lowest values win and the window
    at the very top is not tried.  With h >= n plain mean and standard deviation are
    returned, with fewer than two values nothing.  ``external`` is the external-error
    factor f: the squared mean then enters with 2f - f^2.

    Prefix sums over the ranked values and one join from a window's start to its end replace any per-key loop. With ``few_keys``
    (that fit a broadcast table with their cells) only values that may bound the best window are ranked; the input is then read
    several times instead of being shuffled whole.
    """
    keys = list(keys)
    half = F.floor((F.col("_n") + 2) / 2)
    wanted = half if h is None else F.when(h < 2, half).otherwise(h)
    if few_keys:
        if external is not None:
            raise ValueError("The bounds are those of the plain variance")
        stats, ranked = ranked_candidates(df, keys, value, wanted, median)
    else:
        stats, ranked = ranked_values(df, keys, value)
    stats = stats.where("_n >= 2").withColumn("_h", wanted.cast("bigint"))
    ranked = ranked.where("_n >= 2").withColumn("_h", wanted.cast("bigint"))
    if median:
        middle = [F.max(F.when(F.col("_rank") == F.floor((F.col("_n") + k) / 2), F.col("_x"))) for k in (1, 2)]
        middle = ranked.groupBy(*keys).agg(((middle[0] + middle[1]) / 2).alias("median"))
        stats = joined_on(stats, middle, keys)
    starts = ranked.where("_start") if few_keys else ranked
    starts = starts.where(F.col("_rank") <= F.col("_n") - F.col("_h")).select(
        *keys,
        "_h",
        "_low",
        F.col("_rank").alias("_start"),
        (F.col("_rank") + F.col("_h") - 1).alias("_rank"),
        (F.col("_s1") - F.col("_d")).alias("_b1"),
        (F.col("_s2") - F.col("_d") * F.col("_d")).alias("_b2"),
    )
    windows = joined_on(starts, ranked.select(*keys, "_rank", "_s1", "_s2"), [*keys, "_rank"])
    mean, variance = _moments(
        F.col("_s1") - F.col("_b1"), F.col("_s2") - F.col("_b2"), F.col("_h"), F.col("_low"), external
    )
    best = windows.groupBy(*keys).agg(
        F.min_by(F.struct(mean.alias("mean"), variance.alias("variance")), F.struct(variance.alias("v"), "_start")).alias("_best")
    )
    joined = joined_on(stats, best, keys)
    whole = F.col("_h") >= F.col("_n")
    sigma = scale_factor(F.col("_h"), F.col("_n")) * F.sqrt(F.abs("_best.variance"))
    return joined.select(
        *keys,
        *(["median"] if median else []),
        F.when(whole, F.col("_avg")).otherwise(F.col("_best.mean")).alias("mean"),
        F.when(whole, F.col("_std")).otherwise(sigma).alias("sigma"),
    )


def _moments(s1: Column, s2: Column, h: Column, low: Column, external: float | None) -> tuple[Column, Column]:
    mean = s1 / h
    if external is None:
        return mean + low, (s2 - h * mean * mean) / (h - 1)
    factor = 2 * external - external * external
    centre = mean + low
    square = s2 / h + 2 * low * mean + low * low
    return centre, square - centre * centre * factor


def trimmed_histogram(
    bins: DataFrame, keys: Sequence[str], n: int, lo: float, hi: float, fraction: float
) -> DataFrame:
    """Least-trimmed mean and scale of a histogram at a fraction (at least one half).

    Equal entries of a bin need not be written out: within a stretch of windows that
    start in one bin and end in another the variance is concave in the start, so only
    windows beginning or ending at a bin's first or last entry can be the narrowest.
    The last bin is not used.
    """
    keys = list(keys)
    used = bins.where((F.col("bin") < n - 1) & (F.col("content") > 0))
    so_far = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    d = (F.col("bin") + 0.5) * ((hi - lo) / n)  # measured from the range's lower end
    content = F.col("content").cast("bigint")
    runs = used.withColumns({"_d": d, "_c": content}).withColumns(
        {
            "_to": F.sum("_c").over(so_far),
            "_s1": F.sum(F.col("_c") * F.col("_d")).over(so_far),
            "_s2": F.sum(F.col("_c") * F.col("_d") * F.col("_d")).over(so_far),
            "_n": F.sum("_c").over(whole),
        }
    )
    # entries _from.._to-1 (from 0) lie in the bin; sums before the bin
    runs = runs.withColumns(
        {
            "_from": F.col("_to") - F.col("_c"),
            "_s1": F.col("_s1") - F.col("_c") * F.col("_d"),
            "_s2": F.col("_s2") - F.col("_c") * F.col("_d") * F.col("_d"),
            "_until": F.col("_to") - 1,
        }
    )
    size = F.greatest(
        F.least(F.floor(F.col("_n") * fraction), F.col("_n") - 1), F.floor(F.col("_n") * 0.5)
    ).cast("bigint")
    runs = runs.withColumn("_h", size)
    first, final, h = F.col("_from"), F.col("_until"), F.col("_h")
    starts = (
        runs.select(
            *keys, "_n", "_h", F.explode(F.array(first, final, first + 1 - h, final + 1 - h)).alias("_start")
        )
        .where((F.col("_start") >= 0) & (F.col("_start") <= F.col("_n") - F.col("_h") - 1) & (F.col("_h") >= 2))
        .distinct()
    )
    place = runs.select(*keys, "_from", "_until", "_d", F.col("_s1").alias("_r1"), F.col("_s2").alias("_r2"))

    def prefix(df: DataFrame, at: str, tag: str) -> DataFrame:
        located = range_join(df, place, at, "_from", "_until", on=keys, width=256)
        inside = F.col(at) - F.col("_from")
        return located.withColumns(
            {
                f"_p1{tag}": F.col("_r1") + inside * F.col("_d"),
                f"_p2{tag}": F.col("_r2") + inside * F.col("_d") * F.col("_d"),
            }
        ).drop("_from", "_until", "_d", "_r1", "_r2")

    windows = prefix(starts, "_start", "a").withColumn("_end", F.col("_start") + F.col("_h"))
    windows = prefix(windows, "_end", "b")
    mean, variance = _moments(
        F.col("_p1b") - F.col("_p1a"), F.col("_p2b") - F.col("_p2a"), F.col("_h"), F.lit(lo), None
    )
    best = windows.groupBy(*keys, "_n", "_h").agg(
        F.min_by(F.struct(mean.alias("mean"), variance.alias("variance")), F.struct(variance.alias("v"), "_start")).alias("_best")
    )
    sigma = scale_factor(F.col("_h"), F.col("_n")) * F.sqrt(F.abs("_best.variance"))
    return best.select(*keys, F.col("_best.mean").alias("mean"), sigma.alias("sigma"))
