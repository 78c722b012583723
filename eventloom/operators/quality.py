"""Quality assurance: histograms per trigger group, comparison, severity, status bits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.histograms import histogram


def match_reference(histograms: DataFrame, references: DataFrame, base_name: Column) -> DataFrame:
    """Histograms with their reference: of the same name, else of the name without trigger suffix.

    ``exact`` tells which; without any reference its columns are null.
    """
    columns = [c for c in references.columns if c != "name"]
    same = references.select("name", F.struct(*columns).alias("_same"))
    plain = references.select(F.col("name").alias("_base"), F.struct(*columns).alias("_plain"))
    joined = (
        histograms.withColumn("_base", base_name).join(same, "name", "left").join(plain, "_base", "left")
    )
    chosen = [F.coalesce(F.col(f"_same.{c}"), F.col(f"_plain.{c}")).alias(c) for c in columns]
    return joined.select(*histograms.columns, *chosen, F.col("_same").isNotNull().alias("exact"))


# Severities from worst to best with their score ranges.
FATAL, ERROR, WARNING, INFO = "FATAL", "ERROR", "WARNING", "INFO"
THRESHOLDS = {FATAL: (-1.0, 0.0), ERROR: (0.0, 0.002), WARNING: (0.002, 0.5), INFO: (0.5, 1.0)}
SEVERITY_BITS = {INFO: 0, WARNING: 1, ERROR: 2, FATAL: 3}
BITS_PER_TASK = 4


def matching_groups(fired: Column, groups: Mapping[str, Sequence[str]], keep_original: bool = True) -> Column:
    """Trigger groups an event fills: every alias with a fired class, and "" for the plain histogram."""
    hits = [
        F.when(F.arrays_overlap(fired, F.array(*[F.lit(n) for n in names])), F.lit(alias))
        for alias, names in groups.items()
    ]
    if keep_original:
        hits.append(F.lit(""))
    return F.filter(F.array(*hits), lambda g: g.isNotNull())


def grouped_histogram(
    events: DataFrame, x: Column, n: int, lo: float, hi: float, groups: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """One histogram per trigger group (and ``keys``) from events with their group list."""
    spread = events.select(*keys, x.alias("_x"), F.explode(groups).alias("trigger_group"))
    return histogram(spread, F.col("_x"), n, lo, hi, keys=[*keys, "trigger_group"])


def event_counts(events: DataFrame, keys: Sequence[str], groups: Column) -> DataFrame:
    """Number of events per key and trigger group."""
    spread = events.select(*keys, F.explode(groups).alias("trigger_group"))
    return spread.groupBy(*keys, "trigger_group").agg(F.count("*").alias("n_events"))


def paired_bins(data: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bins of two histograms side by side: ``a`` and ``b``."""
    first = data.select(*keys, "bin", F.col("content").cast("double").alias("a"))
    second = reference.select(*keys, "bin", F.col("content").cast("double").alias("b"))
    both = first.join(second, [*keys, "bin"], "full")
    return both.select(*keys, "bin", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"))


def kolmogorov_probability(z: Column, terms: int = 50) -> Column:
    """Probability of a distance at least as large, by the alternating series."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * z * z),
    )
    return F.when(z < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(2 * series, F.lit(1.0)), F.lit(0.0)))


def kolmogorov_test(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest distance of the cumulated histograms and its probability; 0 if one is empty.

    A key holds the bins of one histogram.
    """
    so_far = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    total_a, total_b = F.sum("a").over(whole), F.sum("b").over(whole)
    gap = F.abs(F.try_divide(F.sum("a").over(so_far), total_a) - F.try_divide(F.sum("b").over(so_far), total_b))
    found = (
        pairs.select(*keys, gap.alias("gap"), "a", "b")
        .groupBy(*keys)
        .agg(F.max("gap").alias("distance"), F.sum("a").alias("na"), F.sum("b").alias("nb"))
    )
    z = F.col("distance") * F.sqrt(F.try_divide(F.col("na") * F.col("nb"), F.col("na") + F.col("nb")))
    usable = (F.col("na") > 0) & (F.col("nb") > 0)
    return found.select(
        *keys,
        F.when(usable, F.col("distance")).alias("distance"),
        F.when(usable, kolmogorov_probability(z)).otherwise(F.lit(0.0)).alias("probability"),
    )


def filled_together(df: DataFrame, specs: dict[str, tuple[Column, Column, int, float, float]]) -> DataFrame:
    """Several histograms (``name, bin, content``) from one scan.

    ``specs`` gives each name its condition, value, number of bins and half-open range.  Every row says at
    once which bin of which histogram it fills; empty bins are left out.
    """
    fills = []
    for name, (wanted, x, n, lo, hi) in specs.items():
        at = F.least(F.floor((x - lo) / (hi - lo) * n), F.lit(n - 1)).cast("bigint")
        inside = F.coalesce(wanted & (x >= lo) & (x < hi), F.lit(False))
        fills.append(F.struct(F.lit(name).alias("name"), F.when(inside, at).alias("bin")))
    rows = df.select(F.inline(F.filter(F.array(*fills), lambda f: f["bin"].isNotNull())))
    return rows.groupBy("name", "bin").agg(F.count("*").alias("content"))


def chi2_distance(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chi-square between two unweighted histograms, and its degrees of freedom."""
    totals = pairs.groupBy(*keys).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    joined = pairs.join(totals, list(keys)).where((F.col("a") + F.col("b") > 0) & (F.col("na") > 0) & (F.col("nb") > 0))
    d = F.col("nb") * F.col("a") - F.col("na") * F.col("b")
    term = d * d / (F.col("a") + F.col("b")) / (F.col("na") * F.col("nb"))
    return joined.groupBy(*keys).agg(F.sum(term).alias("chi2"), (F.count("*") - 1).alias("ndf"))


def chi2_probability(chi2: Column, ndf: Column) -> Column:
    """Upper tail of the chi-square distribution."""

    @F.pandas_udf("double")
    def tail(x: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_upper_gamma(k / 2, v / 2) for v, k in zip(x, n)])

    return tail(chi2, ndf.cast("double"))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below a + 1, continued fraction above."""
    if x <= 0 or a <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-15:
            k += 1
            term *= x / k
            total += term
        return 1 - scale * total
    # evaluated from the far end of the fraction inwards
    depth = 0.0
    for k in range(200, 0, -1):
        depth = k * (k - a) / (x + 2 * k + 1 - a - depth)
    return scale / (x + 1 - a - depth)


def species_score(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean test value per key; -1 if a histogram has no reference, 0 with nothing to check.

    ``scores`` has ``value`` (null without a reference) and ``checked`` (false for a key
    listed without any histogram).
    """
    return scores.groupBy(*keys).agg(
        F.when(F.max(F.col("checked").cast("int")) == 0, 0.0)
        .when(F.max((F.col("checked") & F.col("value").isNull()).cast("int")) == 1, -1.0)
        .otherwise(F.avg("value"))
        .alias("score")
    )


def severity(score: Column, thresholds: Mapping[str, tuple[float, float]] = THRESHOLDS) -> Column:
    """First severity whose range holds the score; the worst without any checker (null)."""
    out = F.when(score.isNull(), FATAL)
    for name, (lo, hi) in thresholds.items():
        inside = (score >= lo) & (score < hi) if name == FATAL else (score > lo) & (score <= hi)
        out = out.when(inside, name)
    return out


def status_words(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status word per key from a log of updates (``seq``, ``task``, ``bit``; null bit clears).

    A task owns four bits and the latest update of a task decides all of them.
    """
    latest = updates.groupBy(*keys, "task").agg(F.max_by(F.struct("bit"), "seq").alias("_last"))
    shift = F.col("task") * BITS_PER_TASK + F.col("_last.bit")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift.cast("int"))
    return latest.groupBy(*keys).agg(F.sum(F.coalesce(one, F.lit(0).cast("bigint"))).alias("status"))


def task_bits(status: Column, task: int) -> Column:
    """The four bits of a task."""
    return F.shiftright(status, task * BITS_PER_TASK).bitwiseAND(F.lit(15).cast("bigint"))


def is_set(status: Column, task: int, bit: int) -> Column:
    return task_bits(status, task).bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0
