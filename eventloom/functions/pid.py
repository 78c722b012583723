"""Particle identification as Column expressions.

Per track the species stand next to each other in a dict of Columns, so expected
signals, likelihoods and posteriors of all species come out of one row without any
join or regrouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.decays import MASSES
from eventloom.functions.energyloss import curve_five

# Species in order, chamber signal of a minimum-ionising particle, its
# relative resolution and cluster term, charge exponent, likelihood range (sigmas).
SPECIES = ("electron", "muon", "pion", "kaon", "proton")
CHARGES = {name: 1 for name in SPECIES}
MIP, RESOLUTION, CLUSTER_TERM, CHARGE_EXPONENT = 50.0, 0.07, 0.0, 2.3
RANGE = 5.0
# Fixed values of the flight-time resolution: momentum terms, smearing (ps), and the lower
# momentum edges of the start-time bins.
MOMENTUM_TERMS, SMEARING = (0.008, 0.008, 0.002), 40.0
START_TIME_EDGES = (0.3, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.2, 1.5, 2.0, 3.0)

Vector = Mapping[str, Column]


def expected_loss(p: Column) -> dict[str, Column]:
    """Expected chamber signal of every species at a momentum."""
    return {
        s: MIP * curve_five(p / MASSES[s]) * CHARGES[s] ** CHARGE_EXPONENT for s in SPECIES
    }


def loss_sigma(expected: Vector, clusters: Column) -> dict[str, Column]:
    spread = F.when(clusters > 0, F.sqrt(1 + CLUSTER_TERM / clusters)).otherwise(F.lit(1.0))
    return {s: expected[s] * RESOLUTION * spread for s in SPECIES}


def n_sigma(signal: Column, expected: Vector, sigma: Vector, available: Column) -> dict[str, Column]:
    """Distance of the signal from each species in sigmas; null without a signal."""
    return {s: F.when(available, F.try_divide(signal - expected[s], sigma[s])) for s in SPECIES}


def start_time_bin(p: Column) -> Column:
    above = sum((F.when(p > edge, 1).otherwise(0) for edge in START_TIME_EDGES[1:-1]), F.lit(0))
    return above


def expected_time(p: Column, length: Column) -> dict[str, Column]:
    """Flight time (ps) over a length (cm)."""
    return {s: length / 0.03 * F.sqrt(1 + MASSES[s] ** 2 / (p * p)) for s in SPECIES}


def time_sigma(
    p: Column, expected: Vector, system: float, start_resolution: Sequence[float]
) -> dict[str, Column]:
    """Momentum, detector and start-time resolutions in quadrature."""
    a, b, c = MOMENTUM_TERMS
    start = F.element_at(F.array(*[F.lit(float(r)) for r in start_resolution]), start_time_bin(p) + 1)
    out = {}
    for s in SPECIES:
        m = MASSES[s]
        relative = a + b * p + c * m / p
        term = relative * expected[s] / (1 + p * p / m**2)
        out[s] = F.sqrt(term * term + SMEARING**2 / (p * p) + system**2 + start * start)
    return out


def likelihoods(sigmas: Vector, sigma: Vector, available: Column, reach: float = RANGE) -> dict[str, Column]:
    """Gaussian densities, cut off at ``reach``; all equal if no species is that close."""
    near = F.lit(False)
    for s in SPECIES:
        near = near | (F.abs(sigmas[s]) <= reach)
    usable = F.coalesce(available & near, F.lit(False))
    flat = F.lit(1 / len(SPECIES))
    out = {}
    for s in SPECIES:
        distance = F.least(F.abs(sigmas[s]), F.lit(reach))
        out[s] = F.when(usable, F.exp(-0.5 * distance * distance) / sigma[s]).otherwise(flat)
    return out


def combined(detectors: Sequence[Vector]) -> dict[str, Column]:
    """Product over detectors; a missing one counts as 1."""
    out = {}
    for s in SPECIES:
        product = F.lit(1.0)
        for d in detectors:
            product = product * F.coalesce(d[s], F.lit(1.0))
        out[s] = product
    return out


def posterior(densities: Vector, priors: Mapping[str, float]) -> dict[str, Column]:
    """Bayes posteriors; -1 if they cannot be normalised.  Negative priors count as 0."""
    weighted = {s: densities[s] * max(priors[s], 0.0) for s in SPECIES}
    total = sum((weighted[s] for s in SPECIES[1:]), weighted[SPECIES[0]])
    return {s: F.when(total > 0, weighted[s] / total).otherwise(F.lit(-1.0)) for s in SPECIES}


def most_probable(values: Vector) -> Column:
    """First species with the highest value, pion if none is above 0."""
    ordered = F.array(*[values[s] for s in SPECIES])
    best = F.array_max(ordered)
    names = F.array(*[F.lit(s) for s in SPECIES])
    at = F.array_position(ordered, best).cast("int")
    return F.when(best > 0, F.element_at(names, F.greatest(at, F.lit(1)))).otherwise(F.lit("pion"))


def is_flat(values: Vector) -> Column:
    flat = F.lit(True)
    for a, b in zip(SPECIES, SPECIES[1:]):
        flat = flat & values[a].eqNullSafe(values[b])
    return flat


def assigned(detector: Vector, all_detectors: Vector, fallback: Column) -> Column:
    """Species by one detector; by all if that one does not discriminate; else the fallback."""
    return (
        F.when(~is_flat(detector), most_probable(detector))
        .when(~is_flat(all_detectors), most_probable(all_detectors))
        .otherwise(fallback)
    )
