"""Histograms, profiles, and estimates from binned data.

A histogram is a table of (keys, bin, content); bins are numbered from 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Heavy ids that keep their own entry, and the entry of all others.
KEPT_HEAVY = (1000010020, 1000010030, 1000020030, 1000020040, 50000050, 50000051)
HEAVY_FROM, HEAVY = 10000, 1111111111

EPSILON = 2.220446049250313e-16


def bin_of(x: Column, n: int, lo, hi) -> Column:
    """Bin with a closed upper end: ``hi`` falls into the last bin, outside is null."""
    at = F.floor((x - lo) / (hi - lo) * n)
    return F.when((x >= lo) & (x <= hi), F.least(at, F.lit(n - 1))).cast("bigint")


def bin_with_overflow(x: Column, n: int, lo: float, hi: float) -> Column:
    """Half-open bins 1..n, 0 below the range and n+1 at or above its end."""
    at = F.floor((x - lo) / (hi - lo) * n) + 1
    return F.when(x < lo, 0).when(x >= hi, n + 1).otherwise(F.least(at, F.lit(n))).cast("bigint")


def centre(bin_: Column, n: int, lo, hi) -> Column:
    return lo + (bin_ + 0.5) * ((hi - lo) / n)


def filled(counts: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Adds the empty bins of each key's histogram, by exploding n numbers per key."""
    bins = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("bin")
    if keys:
        grid = counts.select(*keys).distinct().select(*keys, bins)
    else:
        grid = counts.sparkSession.range(1).select(bins)
    zero = F.lit(0).cast(counts.schema["content"].dataType)
    return grid.join(counts, [*keys, "bin"], "left").withColumn("content", F.coalesce("content", zero))


def histogram(
    df: DataFrame, x: Column, n: int, lo: float, hi: float, keys: Sequence[str] = (), weight: Column | None = None
) -> DataFrame:
    """Fixed-range histogram with all its bins."""
    content = F.count("*") if weight is None else F.sum(weight)
    counts = (
        df.select(*keys, bin_of(x, n, lo, hi).alias("bin"), *([weight.alias("_w")] if weight is not None else []))
        .where(F.col("bin").isNotNull())
        .groupBy(*keys, "bin")
        .agg((content if weight is None else F.sum("_w")).alias("content"))
    )
    return filled(counts, n, keys)


def auto_histogram(df: DataFrame, x: Column, n: int = 100) -> DataFrame:
    """Histogram over the range of the data, with ``lo`` and ``hi``.

    The range is a one-row aggregate, read as a scalar subquery.
    """
    values = df.select(x.alias("_x")).where("_x IS NOT NULL")
    span = values.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    joined = values.select("_x", span.select("lo").scalar().alias("lo"), span.select("hi").scalar().alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1)
    binned = joined.select("lo", width.alias("hi"), "_x").withColumn("bin", bin_of(F.col("_x"), n, F.col("lo"), F.col("hi")))
    counts = binned.groupBy("lo", "hi", "bin").agg(F.count("*").alias("content"))
    return filled(counts, n, ["lo", "hi"])


def histogram_2d(df: DataFrame, x: tuple, y: tuple, weight: Column) -> DataFrame:
    """Weighted counts over two axes ``(column, n, lo, hi)``, with under- and overflow bins."""
    return (
        df.groupBy(bin_with_overflow(*x).alias("x_bin"), bin_with_overflow(*y).alias("y_bin"))
        .agg(F.sum(weight).alias("content"))
    )


def particle_entry(pdg: Column) -> Column:
    """Particle id, with unknown heavy fragments under one common id."""
    size = F.abs(pdg)
    return F.when((size > HEAVY_FROM) & ~size.isin(*KEPT_HEAVY), F.lit(HEAVY)).otherwise(pdg)


def time_profile(steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time, energy-weighted time and number of steps per volume and particle."""
    return steps.groupBy(*keys, particle_entry(F.col("pdg")).alias("pdg")).agg(
        F.sum("dt").alias("time"), F.sum(F.col("energy") * F.col("dt")).alias("e_dt"), F.count("*").alias("n_steps")
    )


def merged(parts: Sequence[DataFrame], keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Partial aggregates added up."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


def frequencies(df: DataFrame, value: Column) -> DataFrame:
    """Values by falling frequency; equally frequent ones by value."""
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def truncated_mean(bins: DataFrame, keys: Sequence[str], n: int, lo: float, hi: float, down: float, up: float) -> DataFrame:
    """Mean and RMS of the bins at which the cumulated fraction lies in (down, up).

    The last bin is not visited.  A histogram has at most n bins per key.
    """
    so_far = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    fraction = F.try_divide(F.sum("content").over(so_far), F.sum("content").over(whole))
    inside = bins.withColumn("_f", fraction).where(
        (F.col("bin") < n - 1) & (F.col("_f") > down) & (F.col("_f") < up)
    )
    x, w = centre(F.col("bin"), n, lo, hi), F.col("content")
    sums = inside.groupBy(*keys).agg(F.sum(w).alias("w"), F.sum(x * w).alias("wx"), F.sum(x * x * w).alias("wxx"))
    mean = F.try_divide(F.col("wx"), F.col("w"))
    rms = F.sqrt(F.abs(F.try_divide(F.col("wxx"), F.col("w")) - mean * mean))
    return sums.select(*keys, mean.alias("mean"), rms.alias("rms"))


def centre_of_gravity(bins: DataFrame, keys: Sequence[str], n: int, lo: float, hi: float) -> DataFrame:
    """Centre of gravity, RMS and sum of the positive bins; ``lo`` if there is none."""
    x = centre(F.col("bin"), n, lo, hi)
    w = F.when(F.col("content") > 0, F.col("content")).otherwise(0)
    sums = bins.groupBy(*keys).agg(
        F.sum(w).alias("w"),
        F.sum(x * w).alias("wx"),
        F.sum(x * x * w).alias("wxx"),
        F.count_if(w > 0).alias("points"),
    )
    cog = F.try_divide(F.col("wx"), F.col("w"))
    spread = F.sqrt(F.abs(cog * cog - F.try_divide(F.col("wxx"), F.col("w"))))
    single = (hi - lo) / n / 12**0.5
    return sums.select(
        *keys,
        F.coalesce(cog, F.lit(float(lo))).alias("cog"),
        F.when(F.col("points") == 1, F.lit(single)).otherwise(spread).alias("rms"),
        F.col("w").alias("sum"),
    )


def parabola(s: Mapping[str, Column], t: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """Coefficients (1, x, x^2) from the moments s0..s4 of x and t0..t2 of y, by determinants."""
    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    s0, s1, s2, s3, s4 = (s[f"s{k}"] for k in range(5))
    t0, t1, t2 = (t[f"t{k}"] for k in range(3))
    whole = det(s0, s1, s2, s1, s2, s3, s2, s3, s4)
    return (
        F.try_divide(det(t0, s1, s2, t1, s2, s3, t2, s3, s4), whole),
        F.try_divide(det(s0, t0, s2, s1, t1, s3, s2, t2, s4), whole),
        F.try_divide(det(s0, s1, t0, s1, s2, t1, s2, s3, t2), whole),
    )


def gaussian_fit(bins: DataFrame, keys: Sequence[str], n: int, lo: float, hi: float) -> DataFrame:
    """Gaussian through the logarithms of the bins above 1, weighted by content.

    ``status``: chi2 per point; -3 with exactly three points, -2 with two and -1 with
    one (centre of gravity), -4 if the maximum is below 4, the sum below 12, the
    contents are all equal or the parabola is degenerate.  Only sums leave the bins,
    x is measured from the middle of the range to keep them well conditioned.
    """
    middle = (lo + hi) / 2
    x = centre(F.col("bin"), n, lo, hi) - middle
    w = F.when(F.col("content") > 1, F.col("content").cast("double"))
    y = F.log(w)
    moments = {f"s{k}": F.sum(w * F.pow(x, F.lit(k))).alias(f"s{k}") for k in range(5)}
    moments |= {f"t{k}": F.sum(w * y * F.pow(x, F.lit(k))).alias(f"t{k}") for k in range(3)}
    sums = bins.groupBy(*keys).agg(
        *moments.values(),
        F.sum(w * y * y).alias("tt"),
        F.count(w).alias("points"),
        F.max("content").alias("peak"),
        F.sum("content").alias("entries"),
        F.stddev_samp("content").alias("spread"),
    )
    s = {f"s{k}": F.col(f"s{k}") for k in range(5)}
    t = {f"t{k}": F.col(f"t{k}") for k in range(3)}
    a, b, c = parabola(s, t)
    sums = sums.withColumns({"a": a, "b": b, "c": c})
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    # sum of w (y - fit)^2 in moments
    chi2 = F.col("tt") - a * t["t0"] - b * t["t1"] - c * t["t2"]
    mean = F.try_divide(b, -2 * c)
    log_peak = a + b * mean + c * mean * mean
    cog = F.try_divide(s["s1"], s["s0"])
    cog_rms = F.sqrt(F.abs(F.try_divide(s["s2"], s["s0"]) - cog * cog))
    # the slope is tested at x = 0 of the histogram's own axis
    slope = b - 2 * c * middle
    bad = (F.col("peak") < 4) | (F.col("entries") < 12) | (F.coalesce(F.col("spread"), F.lit(0.0)) < EPSILON)
    degenerate = F.coalesce((F.abs(slope) < EPSILON) | (F.abs(c) < EPSILON) | (log_peak > 307), F.lit(True))
    fitted = F.col("points") >= 3
    status = (
        F.when(bad | (fitted & degenerate) | (F.col("points") == 0), -4.0)
        .when(F.col("points") == 1, -1.0)
        .when(F.col("points") == 2, -2.0)
        .when(F.col("points") == 3, -3.0)
        .otherwise(chi2 / F.col("points"))
    )
    sums = sums.withColumn("status", status)
    usable = F.col("status") != -4
    peak = F.when(fitted, F.exp(log_peak)).otherwise(F.col("peak").cast("double"))
    width = F.when(fitted, F.try_divide(F.lit(1.0), F.sqrt(F.abs(2 * c)))).otherwise(
        F.when(F.col("points") == 1, F.lit((hi - lo) / n / 12**0.5)).otherwise(cog_rms)
    )
    return sums.select(
        *keys,
        "status",
        F.when(usable, peak).alias("height"),
        F.when(usable, F.when(fitted, mean).otherwise(cog) + middle).alias("mean"),
        F.when(usable, width).alias("sigma"),
        F.col("entries").alias("sum"),
    )


def gaussian_fit_smoothed(bins: DataFrame, keys: Sequence[str], n: int, lo: float, hi: float) -> DataFrame:
    """Two-pass Gaussian fit of a histogram, averaging neighbours where entries are few.

    The averaging width is round(6/sqrt(expected peak)).  The first pass weights a point
    by the number of averaged bins, the second also by the height the first pass
    predicts, leaving out points predicted at or below 1.  ``status`` is chi2 per point
    or -1 (too few entries or points).  A histogram is one array of n contents.
    """
    pairs = F.sort_array(F.collect_list(F.struct("bin", F.col("content").cast("double").alias("content"))))
    width = (hi - lo) / n
    df = bins.groupBy(*keys).agg(F.transform(pairs, lambda p: p["content"]).alias("h"))
    middle = (lo + hi) / 2
    x_at = lambda i: (i + 0.5) * width + lo - middle

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    mean = total(F.transform("h", lambda v, i: v * x_at(i))) / F.col("sum")
    square = total(F.transform("h", lambda v, i: v * x_at(i) * x_at(i))) / F.col("sum")
    df = df.withColumn("sum", total(F.col("h"))).where("sum > 0")
    df = df.withColumn("rms", F.sqrt(F.abs(square - mean * mean)))
    expected = F.col("sum") * width / F.sqrt(2 * F.pi() * F.col("rms"))
    df = df.withColumn("expected", F.when(F.col("rms") > EPSILON, expected))
    df = df.withColumn("d", F.coalesce(F.round(6 / F.sqrt("expected")), F.lit(0)).cast("int"))
    # bins that may be averaged in: not the first, nor the last two
    index = F.sequence(F.lit(0), F.lit(n - 1))

    def point(i: Column) -> Column:
        first = F.greatest(i - F.col("d"), F.lit(1))
        final = F.least(i + F.col("d"), F.lit(n - 3))
        count = F.greatest(final - first + 1, F.lit(0))
        near = total(F.slice("h", first + 1, count))
        k = count + 1
        return F.struct(
            x_at(i).alias("x"), ((F.get("h", i) + near) / k).alias("v"), k.cast("double").alias("k")
        )

    df = df.withColumn("p", F.filter(F.transform(index, point), lambda p: p["v"] > 1))

    def fit(df: DataFrame, weight, points: Column) -> DataFrame:
        used = df.withColumn("q", F.transform(points, lambda p: F.struct(p["x"], F.log(p["v"]).alias("y"), weight(p).alias("w"))))

        def moment(k: int, of_y: bool) -> Column:
            return total(F.transform("q", lambda p: p["w"] * F.pow(p["x"], F.lit(k)) * (p["y"] if of_y else F.lit(1.0))))

        sums = {f"s{k}": moment(k, False) for k in range(5)} | {f"t{k}": moment(k, True) for k in range(3)}
        sums["tt"] = total(F.transform("q", lambda p: p["w"] * p["y"] * p["y"]))
        used = used.withColumns(sums)
        s = {f"s{k}": F.col(f"s{k}") for k in range(5)}
        t = {f"t{k}": F.col(f"t{k}") for k in range(3)}
        a, b, c = parabola(s, t)
        return used.withColumns({"a": a, "b": b, "c": c, "points": F.size("q")})

    first = fit(df, lambda p: p["k"], F.col("p")).withColumn("points0", F.col("points"))
    first = first.withColumns({"a0": F.col("a"), "b0": F.col("b"), "c0": F.col("c")})

    def predicted(p: Column) -> Column:
        return F.exp(F.col("a0") + F.col("b0") * p["x"] + F.col("c0") * p["x"] * p["x"])

    second = fit(first, lambda p: predicted(p) * p["k"], F.filter("p", lambda p: predicted(p) > 1))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    peak_at = F.try_divide(b, -2 * c)
    chi2 = F.col("tt") - a * F.col("t0") - b * F.col("t1") - c * F.col("t2")
    enough = (
        (F.array_max("h") >= 4)
        & (F.col("sum") >= 12)
        & F.coalesce(F.col("expected") >= 1, F.lit(False))
        & (F.col("points0") > 3)
        & (F.col("points") > 3)
    )
    slope = b - 2 * c * middle
    good = enough & F.coalesce((F.abs(slope) >= EPSILON) & (F.abs(c) >= EPSILON), F.lit(False))
    return second.select(
        *keys,
        F.when(good, chi2 / F.col("points")).otherwise(-1.0).alias("status"),
        F.when(good, F.exp(a + b * peak_at + c * peak_at * peak_at)).alias("height"),
        F.when(good, peak_at + middle).alias("mean"),
        F.when(good, F.try_divide(F.lit(1.0), F.sqrt(F.abs(2 * c)))).alias("sigma"),
    )
