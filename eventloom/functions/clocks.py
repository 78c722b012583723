"""Collider clock arithmetic: periods, orbits and bunch crossings.

An orbit has 3564 bunch crossings and lasts 89.1 microseconds in the 25 ns
approximation; a period has 2^24 orbits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ORBITS_PER_PERIOD = 1 << 24
CROSSINGS_PER_ORBIT = 3564
ORBIT_MICROSECONDS = 89.1
CROSSINGS_PER_MICROSECOND = 40.079
NANOSECONDS_PER_CROSSING = 25.0
ORBIT_FREQUENCY = 11245.0
EARLY_ORBITS = -10000


def absolute_orbit(period: Column, orbit: Column) -> Column:
    return period * ORBITS_PER_PERIOD + orbit


def time_key(period: Column, orbit: Column, crossing: Column) -> Column:
    """Orders time stamps: period, then orbit, then bunch crossing."""
    return F.struct(period.alias("period"), orbit.alias("orbit"), crossing.alias("crossing"))


def crossing_from_time(seconds: Column, microseconds: Column) -> Column:
    """Number of bunch crossings in a time, to the nearest."""
    nanoseconds = (seconds * 1e6 + microseconds) * 1000.0
    return F.floor(nanoseconds / NANOSECONDS_PER_CROSSING + 0.5).cast("bigint")


def event_time(
    orbit: Column, period: Column, crossing: Column, fallback: Column,
    start_sec: Column, start_us: Column, start_orbit: Column, start_period: Column, start_crossing: Column,
) -> tuple[Column, Column]:
    """Event time in whole seconds and in precise seconds, from the run's counter start.

    ``fallback`` is used where the run has no start, or the event lies more than
    10000 orbits before the start within the start's period.
    """
    span = orbit - start_orbit
    unusable = (F.coalesce(start_sec, F.lit(0)) == 0) | ((span < EARLY_ORBITS) & (period == start_period))
    unusable = F.coalesce(unusable, F.lit(True))
    orbits = span + period * ORBITS_PER_PERIOD
    # whole microseconds, then whole seconds, both cut towards zero
    micros = _div(orbits * CROSSINGS_PER_ORBIT * 25, 1000) + start_us
    seconds = start_sec + _div(micros, 1000000)
    crossings = orbits * CROSSINGS_PER_ORBIT + crossing - start_crossing % CROSSINGS_PER_ORBIT
    precise = start_sec + (crossings * (1 / CROSSINGS_PER_MICROSECOND) + start_us) / 1000000
    return (
        F.when(unusable, fallback).otherwise(seconds).cast("bigint"),
        F.when(unusable, fallback.cast("double")).otherwise(precise),
    )


def _div(a: Column, b: int) -> Column:
    """Integer quotient, cut towards zero."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))
