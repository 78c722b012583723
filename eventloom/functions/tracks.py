"""Track kinematics as Column expressions.

A track is given in a frame rotated by ``alpha``: local position (x, y, z), sine of
the local azimuth ``snp``, tangent of the dip ``tgl`` and charge over transverse
momentum ``signed1pt``.  Quantities that would divide by zero are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Curvature per field unit (kG), smallest usable field and curvature,
# time-of-flight radius (cm), light speed (cm/ps), bunch spacing (ns).
CURVATURE_PER_FIELD = -0.299792458e-3
SMALLEST_FIELD = 1e-13
SMALLEST_CURVATURE = 1.17549435e-38
TOF_RADIUS = 385.0
LIGHT_SPEED = 3.0e-2
BUNCH_SPACING = 25.0

TWO_PI = 2 * math.pi


def _dbl(c: Column) -> Column:
    return c.cast("double")


def _wrap(phi: Column) -> Column:
    return F.when(phi < 0, phi + TWO_PI).when(phi >= TWO_PI, phi - TWO_PI).otherwise(phi)


# --- flat-table conventions -------------------------------------------------


def phi_flat(snp: Column, alpha: Column) -> Column:
    """Azimuth shifted by pi and not wrapped, as the flat tables define it."""
    return F.asin(_dbl(snp)) + _dbl(alpha) + math.pi


def eta_flat(tgl: Column) -> Column:
    """Pseudorapidity with the flat tables' sign: the negative of :func:`eta`."""
    return F.log(F.tan(math.pi / 4 - F.atan(_dbl(tgl)) / 2))


def pt(signed1pt: Column) -> Column:
    return F.abs(F.try_divide(F.lit(1.0), _dbl(signed1pt)))


# --- event-model conventions ------------------------------------------------


def momentum(tgl: Column, signed1pt: Column) -> Column:
    return F.try_divide(F.sqrt(1 + _dbl(tgl) * _dbl(tgl)), F.abs(_dbl(signed1pt)))


def inverse_momentum(tgl: Column, signed1pt: Column) -> Column:
    return F.abs(_dbl(signed1pt)) / F.sqrt(1 + _dbl(tgl) * _dbl(tgl))


def theta(tgl: Column) -> Column:
    return math.pi / 2 - F.atan(_dbl(tgl))


def phi(snp: Column, alpha: Column) -> Column:
    """Azimuth in [0, 2 pi)."""
    return _wrap(F.asin(_dbl(snp)) + _dbl(alpha))


def eta(tgl: Column) -> Column:
    return -F.log(F.tan(theta(tgl) / 2))


def _cos_local(snp: Column) -> Column:
    return F.sqrt((1 - _dbl(snp)) * (1 + _dbl(snp)))


def global_position(x: Column, y: Column, alpha: Column) -> tuple[Column, Column]:
    return x * F.cos(alpha) - y * F.sin(alpha), x * F.sin(alpha) + y * F.cos(alpha)


def global_momentum(snp: Column, tgl: Column, signed1pt: Column, alpha: Column) -> tuple[Column, Column, Column]:
    """(px, py, pz); null for a straight track without a momentum."""
    p_t = pt(signed1pt)
    px, py = global_position(_cos_local(snp), _dbl(snp), alpha)
    return p_t * px, p_t * py, p_t * _dbl(tgl)


def position_phi(x: Column, y: Column, alpha: Column) -> Column:
    """Azimuth of the position, in [0, 2 pi)."""
    gx, gy = global_position(x, y, alpha)
    return _wrap(F.atan2(gy, gx))


def curvature(signed1pt: Column, field: Column) -> Column:
    return _dbl(signed1pt) * field * CURVATURE_PER_FIELD


def _to_point(x, y, alpha, at_x, at_y) -> tuple[Column, Column]:
    """Track position relative to a global point, in the track's frame."""
    return x - (at_x * F.cos(alpha) + at_y * F.sin(alpha)), y - (at_y * F.cos(alpha) - at_x * F.sin(alpha))


def linear_impact(x, y, alpha, snp, at_x, at_y) -> Column:
    """Transverse impact parameter of the straight line through the track."""
    dx, dy = _to_point(x, y, alpha, at_x, at_y)
    return dy * _cos_local(snp) - dx * snp


def _chord(dx: Column, dy: Column, snp: Column, c: Column) -> tuple[Column, Column, Column]:
    """Helix seen from the point: its local sine and cosine terms and the impact numerator."""
    cos = _cos_local(snp)
    return c * dx - snp, c * dy + cos, c * (dx * dx + dy * dy) - 2 * (dx * snp - dy * cos)


def impact(x, y, alpha, snp, signed1pt, at_x, at_y, field) -> Column:
    """Transverse impact parameter of the helix; straight line without a field."""
    dx, dy = _to_point(x, y, alpha, at_x, at_y)
    sn, cs, numerator = _chord(dx, dy, snp, curvature(signed1pt, field))
    return F.when(
        F.abs(field) < SMALLEST_FIELD, linear_impact(x, y, alpha, snp, at_x, at_y)
    ).otherwise(numerator / (1 + F.sqrt(sn * sn + cs * cs)))


def impact_dz(x, y, z, alpha, snp, tgl, signed1pt, at_x, at_y, at_z, field) -> tuple[Column, Column]:
    """Transverse and longitudinal impact parameters to a point."""
    dx, dy = _to_point(x, y, alpha, at_x, at_y)
    cos = _cos_local(snp)
    c = curvature(signed1pt, field)
    straight = (F.abs(field) < SMALLEST_FIELD) | (F.abs(c) < SMALLEST_CURVATURE)
    sn, cs, numerator = _chord(dx, dy, snp, c)
    norm = F.sqrt(sn * sn + cs * cs)
    end_sin = -sn / norm
    line = linear_impact(x, y, alpha, snp, at_x, at_y)
    line_z = z + (line * snp - dx) / cos * tgl - at_z
    turn = F.asin(end_sin * cos - snp * F.sqrt((1 - end_sin) * (1 + end_sin)))
    helix_z = z + F.try_divide(tgl, c) * turn - at_z
    return (
        F.when(straight, line).otherwise(numerator / (1 + norm)),
        F.when(straight, line_z).otherwise(helix_z),
    )


# --- cluster and time-of-flight quantities ----------------------------------


def per_cluster(chi2: Column, clusters: Column) -> Column:
    """chi2 per cluster, 0 for a track without clusters."""
    return F.when(clusters > 0, chi2 / clusters).otherwise(F.lit(0.0))


def tof_time_difference(signal, expected, mass, tgl, signed1pt, field, available) -> Column:
    """Measured minus expected flight time (ns).

    ``expected`` (ps) is the integrated time; where it is null the time over the
    helix path to the detector radius is used.  Null if the detector gave no signal
    or the momentum is below 0.01.
    """
    p = momentum(tgl, signed1pt)
    c = curvature(signed1pt, field)
    arc = F.try_divide(F.lit(2.0), c) * F.asin(TOF_RADIUS * c / 2) * F.sqrt(1 + tgl * tgl)
    path = F.when(F.abs(c) > SMALLEST_CURVATURE, arc).otherwise(F.lit(TOF_RADIUS))
    over_path = F.when(p >= 0.01, path / LIGHT_SPEED * F.sqrt(1 + mass * mass / (p * p)))
    return F.when(available, (signal - F.coalesce(expected, over_path)) * 1e-3)


def tof_bunch(time_difference: Column) -> Column:
    """Bunch crossings after the trigger, rounded half away from zero."""
    return F.round(time_difference / BUNCH_SPACING).cast("int")
