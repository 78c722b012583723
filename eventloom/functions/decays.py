"""Two- and three-body decay kinematics as Column expressions.

A momentum or a position is a tuple of three Columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]

# Particle masses (GeV).
MASSES = {
    "electron": 0.000510998928,
    "muon": 0.1056583715,
    "pion": 0.13957018,
    "kaon": 0.493677,
    "proton": 0.938272046,
    "k0s": 0.497614,
    "lambda": 1.115683,
    "xi": 1.32171,
    "omega": 1.67245,
}

# Particle codes of the masses, without sign.
CODES = {
    11: "electron",
    13: "muon",
    211: "pion",
    321: "kaon",
    2212: "proton",
    310: "k0s",
    3122: "lambda",
    3312: "xi",
    3334: "omega",
}

# Daughter masses, parent mass and decay momentum of each hypothesis.
# code: (positive leg, negative leg, parent, momentum)
PAIR_HYPOTHESES = {
    310: ("pion", "pion", "k0s", 0.206),
    3122: ("proton", "pion", "lambda", 0.101),
    -3122: ("pion", "proton", "lambda", 0.101),
}
PAIR_DEFAULT = 310

# Fixed values of the three-body test, given with five decimals.
# code: (positive leg mass, negative leg mass, bachelor mass, parent mass, momentum)
CASCADE_HYPOTHESES = {
    3312: (0.93827, 0.13957, 0.13957, 1.3213, 0.139),
    -3312: (0.13957, 0.93827, 0.13957, 1.3213, 0.139),
    3334: (0.93827, 0.13957, 0.49368, 1.67245, 0.211),
    -3334: (0.13957, 0.93827, 0.49368, 1.67245, 0.211),
}
CASCADE_PAIR_MASS = 1.11568
CASCADE_PAIR_MOMENTUM = 0.101


def mass_of(code: Column) -> Column:
    """Mass of a particle code or its negative, null if not tabulated."""
    size = F.abs(code)
    out = None
    for number, name in CODES.items():
        out = F.when(size == number, MASSES[name]) if out is None else out.when(size == number, MASSES[name])
    return out


def add(*vectors: Vector) -> Vector:
    return tuple(sum(parts[1:], parts[0]) for parts in zip(*vectors))


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def energy(p: Vector, mass) -> Column:
    return F.sqrt(mass * mass + dot(p, p))


def rapidity(p: Vector, mass) -> Column:
    e = energy(p, mass)
    return 0.5 * F.log((e + p[2]) / (e - p[2] + 1e-13))


def _along(p: Vector, total: Vector) -> Column:
    return F.try_divide(dot(p, total), norm(total))


def armenteros_alpha(positive: Vector, negative: Vector) -> Column:
    """Longitudinal asymmetry of two legs; for a cascade give (pair, bachelor)."""
    total = add(positive, negative)
    a, b = _along(positive, total), _along(negative, total)
    return F.try_divide(a - b, a + b)


def armenteros_pt(leg: Vector, total: Vector) -> Column:
    """Momentum of a leg transverse to the total momentum."""
    return F.try_divide(norm(cross(leg, total)), norm(total))


def pair_mass(positive: Vector, negative: Vector, mass_positive, mass_negative) -> Column:
    product = energy(positive, mass_positive) * energy(negative, mass_negative)
    square = mass_positive**2 + mass_negative**2 + 2 * (product - dot(positive, negative))
    return F.sqrt(F.greatest(square, F.lit(0.0)))


def two_body(first: Vector, second: Vector) -> dict[str, Column]:
    """What the hypothesis tests need of two momenta; worth a column each, as all tests share it."""
    total = add(first, second)
    return {
        "p": norm(total),
        "along_first": _along(first, total),
        "along_second": _along(second, total),
        "first2": dot(first, first),
        "second2": dot(second, second),
    }


def _quality(s: Mapping[str, Column], e_total: Column, m_first, m_second, parent, momentum) -> Column:
    """How far the decay is from the two-body kinematics of ``parent`` (0 = exact)."""
    a, b = s["along_first"], s["along_second"]
    beta = s["p"] / e_total
    asymmetry = F.try_divide(a - b, a + b) - (m_first**2 - m_second**2) / parent**2
    transverse2 = s["first2"] - a * a
    return 0.25 * beta * beta * parent**2 * asymmetry * asymmetry + transverse2 - momentum**2


def pair_hypothesis(s: Mapping[str, Column], code: int) -> tuple[Column, Column]:
    """(invariant mass, kinematic quality) of a pair (positive, negative leg) under a hypothesis."""
    plus, minus, parent, momentum = PAIR_HYPOTHESES.get(code, PAIR_HYPOTHESES[PAIR_DEFAULT])
    m_plus, m_minus, m_parent = MASSES[plus], MASSES[minus], MASSES[parent]
    e = F.sqrt(m_plus**2 + s["first2"]) + F.sqrt(m_minus**2 + s["second2"])
    mass = F.sqrt(F.greatest(e * e - s["p"] * s["p"], F.lit(0.0)))
    return mass, _quality(s, e, m_plus, m_minus, m_parent, momentum)


def cascade_hypothesis(
    inner: Mapping[str, Column], outer: Mapping[str, Column], code: int
) -> tuple[Column, Column, Column]:
    """(mass, quality, quality of the inner pair) of a cascade under a hypothesis.

    ``inner`` is :func:`two_body` of the pair's legs, ``outer`` that of (pair, bachelor).
    """
    m_plus, m_minus, m_bachelor, parent, momentum = CASCADE_HYPOTHESES[code]
    e_pair = F.sqrt(CASCADE_PAIR_MASS**2 + outer["first2"])
    pair_quality = _quality(inner, e_pair, m_plus, m_minus, CASCADE_PAIR_MASS, CASCADE_PAIR_MOMENTUM)
    e = e_pair + F.sqrt(m_bachelor**2 + outer["second2"])
    mass = F.sqrt(F.greatest((e - outer["p"]) * (e + outer["p"]), F.lit(0.0)))
    return mass, _quality(outer, e, CASCADE_PAIR_MASS, m_bachelor, parent, momentum), pair_quality


def impact_2d(at: Vector, p: Vector, point: Vector) -> Column:
    dx, dy = point[0] - at[0], point[1] - at[1]
    return F.try_divide(F.abs(dx * p[1] - dy * p[0]), F.sqrt(p[0] * p[0] + p[1] * p[1]))


def impact_3d(at: Vector, p: Vector, point: Vector) -> Column:
    away = tuple(a - b for a, b in zip(point, at))
    return F.try_divide(norm(cross(away, p)), norm(p))


def cos_pointing(at: Vector, p: Vector, point: Vector) -> Column:
    flight = tuple(a - b for a, b in zip(at, point))
    return F.try_divide(dot(flight, p), norm(p) * norm(flight))


def mass_margin(pt: Column, field: Column, sigmas, sigma, c0, c1, add_on) -> Column:
    """Half width of the accepted mass window at a transverse momentum and field."""
    scale = F.when(F.abs(field) > 1e-3, 5.00668 / F.abs(field)).otherwise(F.lit(1.0))
    return sigmas * scale * sigma * (c0 + c1 * pt) + add_on
