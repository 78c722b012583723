"""Trigger-counter time series: overflow, consistency, rates, pile-up and luminosity.

Counters are raw 32-bit readings; a record has one value per level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clocks import ORBIT_FREQUENCY, ORBIT_MICROSECONDS
from eventloom.operators.ordered import stepped

# Counter range, smallest drop taken for an overflow, allowed excess of a
# level over the one before it (a larger one for the pair at index 1), bunches.
RANGE = 1 << 32
OVERFLOW_DROP = 1_000_000_000
LEVEL_EXCESS = 16
EARLY_LEVEL_EXCESS = 512
EARLY_PAIR = 1


def overflowed(now: Column, before: Column) -> Column:
    return (now < before) & (before - now > OVERFLOW_DROP)


def corrected(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, levels: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Adds the count of every level continued over its overflows.

    ``<level>_total`` is the reading plus 2^32 for each overflow so far; ``<level>_before`` and
    ``prev_<column>`` (of ``order`` and ``carry``) are the previous record's.
    """
    prev = {f"_p_{c}": F.col(c) for c in levels} | {f"prev_{c}": F.col(c) for c in (*order, *carry)}
    steps = {f"_o_{c}": overflowed(F.col(c), F.col(f"_p_{c}")) for c in levels}
    df = stepped(df, keys, block, order, prev, steps, uses=levels)
    now = {c: F.coalesce(overflowed(F.col(c), F.col(f"_p_{c}")), F.lit(False)).cast("bigint") for c in levels}
    totals = {f"{c}_total": F.col(c) + F.col(f"_o_{c}") * RANGE for c in levels}
    befores = {f"{c}_before": F.col(f"_p_{c}") + (F.col(f"_o_{c}") - now[c]) * RANGE for c in levels}
    return df.withColumns(totals | befores).drop(*[f"_{k}_{c}" for k in "po" for c in levels])


def verdict(levels: Sequence[str], time: Sequence[str]) -> Column:
    """Consistency of a corrected record with the previous one: 0 good, 1 or 2 bad.

    2: a level decreased without overflow.  1: time decreased, or a level counted more
    than the level before it by 16 or more (by more than 512 for the second pair).
    """
    growth = [F.col(f"{c}_total") - F.col(f"{c}_before") for c in levels]
    decreased, exceeded = F.lit(False), F.lit(False)
    for g in growth:
        decreased = decreased | (g < 0)
    for i, (upper, lower) in enumerate(zip(growth, growth[1:])):
        excess = lower - upper
        exceeded = exceeded | (
            excess > EARLY_LEVEL_EXCESS if i == EARLY_PAIR else excess >= LEVEL_EXCESS
        )
    now = F.struct(*time)
    before = F.struct(*[F.col(f"prev_{c}").alias(c) for c in time])
    first = F.col(f"prev_{time[0]}").isNull()
    return (
        F.when(first, 0).when(now < before, 1).when(decreased, 2).when(exceeded, 1).otherwise(0)
    )


def consistent_runs(checked: DataFrame, keys: Sequence[str], code: str = "code") -> DataFrame:
    """The rows of runs in which no record fails."""
    bad = checked.where(F.col(code) != 0).select(*keys).distinct()
    return checked.join(bad, list(keys), "left_anti")


def whole_run_delta(df: DataFrame, keys: Sequence[str], order: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Last minus first reading of each level, from partial aggregates."""
    at = F.struct(*order)
    deltas = [(F.max_by(c, at) - F.min_by(c, at)).alias(f"d_{c}") for c in levels]
    return df.groupBy(*keys).agg(*deltas, F.count("*").alias("n_records"))


def intervals(records: DataFrame, keys: Sequence[str], time: str, levels: Mapping[str, str]) -> DataFrame:
    """One row per pair of neighbouring records, from corrected ones.

    ``start`` and ``d_time`` say when and how long; ``d_<name>`` is the growth of each of the
    named levels.
    """
    growth = [(F.col(f"{c}_total") - F.col(f"{c}_before")).alias(f"d_{n}") for n, c in levels.items()]
    start = F.col(f"prev_{time}")
    return records.where(start.isNotNull()).select(
        *keys, F.col("prev_rec").alias("rec"), start.alias("start"), (F.col(time) - start).alias("d_time"), *growth
    )


def seconds(orbits: Column) -> Column:
    """Duration of a number of orbits."""
    return orbits * ORBIT_MICROSECONDS * 1e-6


def rate(counts: Column, duration: Column) -> tuple[Column, Column]:
    """(rate, error)."""
    return F.try_divide(counts, duration), F.try_divide(F.sqrt(counts.cast("double")), duration)


def ratio(level2: Column, level0: Column) -> tuple[Column, Column]:
    """(fraction of level-0 counts passing level 2, its binomial error)."""
    l2, l0 = level2.cast("double"), level0.cast("double")
    return F.try_divide(l2, l0), F.try_divide(F.sqrt(F.abs(l2 - F.try_divide(l2 * l2, l0))), l0)


def pile_up(
    counts: Column, trials: Column, background: Column, background_trials: Column,
    efficiency: float = 1.0, efficiency_error: float = 0.0,
) -> tuple[Column, Column]:
    """Mean interactions per crossing and its error, corrected for beam-gas background.

    ``trials`` is bunches times orbits, or a beam counter.  Without background trials
    there is no correction; null without trials or with a probability of 1 and above.
    """
    p = F.try_divide(counts.cast("double"), trials)
    p_bg = F.coalesce(F.try_divide(background.cast("double"), background_trials), F.lit(0.0))
    usable = (p < 1) & (p_bg < 1)
    p, p_bg = F.when(usable, p), F.when(usable, p_bg)
    mu = (F.log(1 - p_bg) - F.log(1 - p)) / efficiency
    variance = p / ((1 - p) * trials) + F.coalesce(F.try_divide(p_bg, (1 - p_bg) * background_trials), F.lit(0.0))
    return mu, F.sqrt(variance + mu * mu * (efficiency_error / efficiency) ** 2)


def since_last(now: Column, before: Column) -> Column:
    """Counts between two raw readings with at most one overflow."""
    return F.when(now >= before, now - before).otherwise(now - before + RANGE)


def curve_point(time: Column, duration: Column, start: Column) -> tuple[Column, Column]:
    """(mid-point of an interval since the run's start, half its width)."""
    return time - start + duration / 2, duration / 2


def luminosity(counts: Column, duration: Column, bunches, cross_section) -> dict[str, Column]:
    """Luminosity of an interval from a reference class, corrected for pile-up.

    mu = -ln(1 - counts / crossings); the interaction rate is divided by the visible
    cross-section.  Intervals under a microsecond give null.
    """
    crossings = duration * ORBIT_FREQUENCY * bunches
    fraction = F.try_divide(counts.cast("double"), crossings)
    mu = F.when((duration >= 1e-6) & (fraction < 1), -F.log(1 - fraction))
    value = mu * ORBIT_FREQUENCY * bunches / cross_section
    error = F.when(counts > 0, value / F.sqrt(counts.cast("double"))).when(mu.isNotNull(), 0.0)
    return {"mu": mu, "lumi": value, "error": error}
