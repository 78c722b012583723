"""Forward-muon kinematics and trigger matching as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MUON_MASS = 0.105658369


def momentum(inv_bending: Column, theta_x: Column, theta_y: Column) -> tuple[Column, Column, Column, Column, Column]:
    """(px, py, pz, p, energy) from the slopes; null when the inverse momentum is 0.

    The spectrometer looks towards negative z.
    """
    p_yz = F.abs(F.try_divide(F.lit(1.0), inv_bending))
    slope_y, slope_x = F.tan(theta_y), F.tan(theta_x)
    pz = -p_yz / F.sqrt(1 + slope_y * slope_y)
    px, py = pz * slope_x, pz * slope_y
    p2 = px * px + py * py + pz * pz
    return px, py, pz, F.sqrt(p2), F.sqrt(p2 + MUON_MASS * MUON_MASS)


def degrees_of_freedom(hits: Column) -> Column:
    return F.greatest(2 * hits - 5, F.lit(0))


def normalised_chi2(chi2: Column, hits: Column) -> Column:
    ndf = degrees_of_freedom(hits)
    return F.when(ndf > 0, chi2 / ndf).otherwise(F.lit(0.0))


def trigger_match(circuit: Column, low_pt: Column, high_pt: Column) -> Column:
    """0 no match, 1 matched below the cuts, 2 low-pt cut, 3 high-pt cut."""
    return (
        F.when(circuit == 0, 0)
        .when((low_pt == 0) & (high_pt == 0), 1)
        .when((low_pt > 0) & (high_pt == 0), 2)
        .otherwise(3)
    )


def chambers_matched(pattern: Column) -> Column:
    """True if both planes of at least two of the four trigger chambers are hit.

    Bits 7..4 are the first plane's chambers, 3..0 the second plane's.
    """
    both = F.bit_count(F.shiftright(pattern, 4).bitwiseAND(pattern).bitwiseAND(F.lit(15)))
    return both >= 2
