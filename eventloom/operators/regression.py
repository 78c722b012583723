"""Local regression on a grid in several dimensions, and kernel smoothing in one.

A grid is a list of axes ``(column, n, lo, hi)``; bins are numbered from 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import moments, robust
from eventloom.operators.asof import asof
from eventloom.operators.ordered import blocked
from eventloom.operators.ranges import range_join
from eventloom.operators.solve import solved, solved_sums, summed
from eventloom.session import stored

Axis = tuple[str, int, float, float]

# Least robust subset; largest exponent and least points of the smoother.
SMALLEST_SUBSET = 3
SMOOTH_LIMIT = 100.0
SMOOTH_LEAST = 4
#: The sums over a window of more points come from the moments of cells.
SMOOTH_PAIRS = 128


def _width(axis: Axis) -> float:
    return (axis[3] - axis[2]) / axis[1]


def bin_columns(grid: Sequence[Axis]) -> list[str]:
    return [f"bin_{i}" for i in range(len(grid))]


def _near(points: DataFrame, grid: Sequence[Axis], kernels: Sequence[Column], weight_cut: float) -> DataFrame:
    """Points copied to every grid bin in kernel range, with ``_chi2`` and ``_d<i>`` from its centre.

    The range of bins per axis follows from the kernel width, so a point is never paired
    with the whole grid.
    """
    limit = -2 * math.log(weight_cut)
    df = points
    for i, (axis, kernel) in enumerate(zip(grid, kernels)):
        column, n, lo, _ = axis
        w = _width(axis)
        reach = kernel * math.sqrt(limit)
        x = F.col(column)
        first = F.greatest(F.ceil((x - reach - lo) / w - 0.5), F.lit(0)).cast("int")
        final = F.least(F.floor((x + reach - lo) / w - 0.5), F.lit(n - 1)).cast("int")
        bins = F.when(final >= first, F.sequence(first, final))
        df = df.withColumn(f"bin_{i}", F.explode(bins))
        d = x - (lo + (F.col(f"bin_{i}") + 0.5) * w)
        df = df.withColumns({f"_d{i}": d, f"_q{i}": d * d / (kernel * kernel)})
    chi2 = sum((F.col(f"_q{i}") for i in range(1, len(grid))), F.col("_q0"))
    return df.withColumn("_chi2", chi2).where(F.col("_chi2") <= limit)


def local_fit(
    points: DataFrame, grid: Sequence[Axis], kernels: Sequence[Column], value: str, error: str,
    weight_cut: float = 1e-5, bin_units: bool = False, statistics: DataFrame | None = None,
    cut: float | None = None, around: str = "median",
) -> DataFrame:
    """Separable quadratic fit around every grid bin: ``coefficients`` (constant, then d and d^2 per axis).

    A point's error grows by exp(chi2/2) with its kernel distance.  Bins with no more
    than 2 d + 2 points have no fit.  With ``statistics`` (from :func:`local_statistics`)
    points farther than ``cut`` times the local spread from the local ``around`` are left out.
    """
    near = _near(points, grid, kernels, weight_cut)
    bins = bin_columns(grid)
    if statistics is not None:
        near = near.join(statistics, bins).where(F.abs(F.col(value) - F.col(around)) <= cut * F.col("sigma"))
    basis = [F.lit(1.0)]
    for i, axis in enumerate(grid):
        d = F.col(f"_d{i}") / (_width(axis) if bin_units else 1.0)
        basis += [d, d * d]
    weight = F.exp(-F.col("_chi2")) / (F.col(error) * F.col(error))
    fits = solved(near, bins, basis, F.col(value), weight)
    return fits.where((F.col("n_points") > 2 * len(grid) + 2) & F.col("coefficients").isNotNull())


def local_statistics(
    points: DataFrame, grid: Sequence[Axis], kernels: Sequence[Column], value: str, weight_cut: float = 1e-5,
    fraction: float = 0.6,
) -> DataFrame:
    """Median, and robust mean and sigma (of the given fraction), of the points near each bin.

    All 0 where too few points are near.
    """
    near = _near(points, grid, kernels, weight_cut)
    bins = bin_columns(grid)
    fraction = min(fraction, 1.0)
    subset = F.floor(F.col("_n") * fraction - 1)
    near = near.where(F.col(value).isNotNull()).select(*bins, value)
    spread = robust.location_and_scale(near, bins, value, h=subset, median=True, few_keys=True)
    joined = near.groupBy(*bins).agg(F.count("*").alias("_near")).join(spread, bins, "left")
    enough = F.col("_near") * fraction - 1 > SMALLEST_SUBSET
    numbers = [F.when(enough, F.col(c)).otherwise(0.0).alias(c) for c in ("median", "mean", "sigma")]
    return joined.select(*bins, *numbers)


def evaluated(
    points: DataFrame, fits: DataFrame, grid: Sequence[Axis], bin_units: bool = False
) -> DataFrame:
    """``fit`` value, ``fit_error`` and per axis the ``slope_<i>`` at each point; 0 without a fit.

    Points outside the grid are moved to its edge.  The error is that of the bin centre.
    """
    df = points
    for i, (column, n, lo, hi) in enumerate(grid):
        x = F.greatest(F.least(F.col(column), F.lit(float(hi))), F.lit(float(lo)))
        at = F.least(F.floor((x - lo) / _width(grid[i])), F.lit(n - 1)).cast("int")
        df = df.withColumns({f"_x{i}": x, f"bin_{i}": at})
    bins = bin_columns(grid)
    df = df.join(fits.select(*bins, "coefficients", "variances"), bins, "left")
    c = lambda k: F.element_at("coefficients", k + 1)
    value, slopes = c(0), {}
    for i, axis in enumerate(grid):
        unit = _width(axis) if bin_units else 1.0
        d = (F.col(f"_x{i}") - (axis[2] + (F.col(f"bin_{i}") + 0.5) * _width(axis))) / unit
        value = value + c(2 * i + 1) * d + c(2 * i + 2) * d * d
        slopes[f"slope_{i}"] = (c(2 * i + 1) + 2 * c(2 * i + 2) * d) / unit
    out = {"fit": value, "fit_error": F.sqrt(F.element_at("variances", 1)), **slopes}
    out = {n: F.coalesce(v, F.lit(0.0)) for n, v in out.items()}
    helpers = [*bins, *[f"_x{i}" for i in range(len(grid))], "coefficients", "variances"]
    return df.withColumns(out).drop(*helpers)


def smoothed(
    requests: DataFrame, series: DataFrame, keys: Sequence[str], width: float, sigmas: float, degree: int,
    block_width: float, logarithm: bool = False,
) -> DataFrame:
    """Kernel-weighted polynomial at the time ``t`` of each request: ``smooth``.

    Points (``t``, ``y``, ``id``) from the last one before the window of ``sigmas`` widths to the
    last one inside count with weight exp(-2 x^2 / w^2); with fewer than five the two
    points on either side of the time are taken.  The degree is lowered to the number of
    steps less 2; 0 with four points or fewer.  Points are numbered along time, so a
    request asks for a range of numbers, and its points are reduced to sums right away. A window of more than
    SMOOTH_PAIRS points is not joined to them but added up from the moments of cells, so the work per request does
    not follow the density of the points.
    """
    keys = list(keys)
    names = list(requests.columns)
    ranked = blocked(
        series, keys, F.floor(F.col("t") / block_width), ["t", "id"],
        running={"_rank": F.lit(1).cast("bigint")}, lead={"_ahead": F.struct(F.col("t"))},
    )
    ranked = ranked.select(
        *keys, F.col("t").alias("_t"), F.col("y").alias("_y"), (F.col("_rank") - 1).alias("_place"), F.col("_ahead.t").alias("_next")
    )
    sizes = ranked.groupBy(*keys).agg(F.count("*").alias("_size"), F.min("_t").alias("_begin"))
    reach = sigmas * width
    # one stream of three questions per request: the places before the window, in its middle and at its end
    asked = requests.select(
        "*",
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("_which"), at.alias("_ask")) for n, at in
                      (("_i0", F.col("t") - reach), ("_im", F.col("t")), ("_i1", F.col("t") + reach))])
        ),
    )
    answers = asof(asked, ranked, keys, F.col("_ask"), F.col("_t"), block_width, right_order=["_place"], match="_m")
    place = F.coalesce(F.col("_m._place"), F.lit(-1).cast("bigint"))
    df = answers.groupBy(*names).agg(
        *[F.max(F.when(F.col("_which") == n, place)).alias(n) for n in ("_i0", "_im", "_i1")],
        *[F.max(F.when(F.col("_which") == "_im", F.col(f"_m.{n}"))).alias(n) for n in ("_t", "_next")],
    )
    df = df.join(sizes, keys, "left")
    half = SMOOTH_LEAST // 2
    few = F.col("_i1") - F.col("_i0") < SMOOTH_LEAST
    first = F.when(few, F.col("_im") - half).otherwise(F.col("_i0"))
    final = F.when(few, F.col("_im") + half).otherwise(F.col("_i1"))
    df = df.withColumns({"_lo": first, "_hi": final})
    # moved back into the series at either end
    df = df.withColumns(
        {
            "_hi": F.when(F.col("_lo") < 0, F.col("_hi") - F.col("_lo")).otherwise(F.col("_hi")),
            "_lo": F.greatest(F.col("_lo"), F.lit(0).cast("bigint")),
        }
    )
    over = F.col("_hi") >= F.col("_size")
    df = df.withColumns(
        {
            "_lo": F.greatest(
                F.when(over, F.col("_lo") - (F.col("_hi") - F.col("_size"))).otherwise(F.col("_lo")),
                F.lit(0).cast("bigint"),
            ),
            "_hi": F.when(over, F.col("_size") - 1).otherwise(F.col("_hi")),
        }
    )
    steps = F.greatest(F.col("_hi") - F.col("_lo") - 2, F.lit(0).cast("bigint"))
    # powers are taken of the distance from the nearest point: from elsewhere it would drown all the others
    later = F.col("_next") - F.col("t") < F.col("t") - F.col("_t")
    centre = F.when(F.col("_t").isNull(), F.col("_begin")).when(later, F.col("_next")).otherwise(F.col("_t"))
    number = (F.least(F.lit(degree), steps) + 1).cast("int")
    # beyond the largest exponent the weights are no Gaussian
    dense = (F.col("_hi") - F.col("_lo") > SMOOTH_PAIRS) & ~few & F.col("_size").isNotNull() & (sigmas * sigmas <= SMOOTH_LIMIT)
    dense = F.coalesce(dense, F.lit(False)).alias("_dense")
    asked = df.select(*names, "_lo", "_hi", "_i0", "_i1", number.alias("_number"), centre.alias("_centre"), dense)
    asked = stored(asked, "asked")
    # the one point of a dense window that is not in reach: the last before it, or the one behind it if there is none before
    beside = F.when(F.col("_i0") >= 0, F.col("_lo")).when(F.col("_hi") > F.col("_i1"), F.col("_hi"))
    single = {n: F.when(F.col("_dense"), beside).otherwise(F.col(n)) for n in ("_lo", "_hi")}
    group = [*names, "_number", "_centre"]
    near = range_join(ranked, asked.select(*group, *[c.alias(n) for n, c in single.items()]), "_place", "_lo", "_hi", on=keys, width=16)
    if logarithm:
        near = near.where("_y > 0").withColumn("_y", F.log("_y"))
        series = series.where("y > 0").withColumn("y", F.log("y"))
    u = (F.col("_t") - F.col("t")) / width
    near = near.withColumn("_u", u).withColumn("_w", F.exp(-2 * F.least(F.col("_u") * F.col("_u"), F.lit(SMOOTH_LIMIT))))
    near = near.withColumn("_v", (F.col("_t") - F.col("_centre")) / width)
    # one set of sums per request; a lower degree is solved from the first of them
    basis = [F.pow("_v", F.lit(p)) for p in range(degree + 1)]
    sums = summed(near, group, basis, F.col("_y"), F.col("_w")).drop("_vv")
    sums = sums.unionByName(moments.window_sums(asked.where("_dense").select(*group), series, keys, width, sigmas, degree))
    sums = sums.groupBy(*group).agg(*[F.sum(c).alias(c) for c in sums.columns if c not in group])
    fit = solved_sums(sums.withColumn("_vv", F.lit(None).cast("double")), group, degree + 1, F.col("_number"))
    here = (F.col("t") - F.col("_centre")) / width
    value = F.element_at("coefficients", 1)
    for p in range(1, degree + 1):
        value = value + F.element_at("coefficients", p + 1) * F.pow(here, F.lit(p))
    found = fit.where(F.col("n_points") > SMOOTH_LEAST).select(*names, value.alias("smooth"))
    joined = requests.join(found, names, "left")
    value = F.exp("smooth") if logarithm else F.col("smooth")
    return joined.withColumn("smooth", F.coalesce(value, F.lit(0.0)))
