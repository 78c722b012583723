"""Distances with covariances, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_distance(d: Mapping[str, Column], cov: Mapping[str, Column]) -> Column:
    """sqrt(d' C^-1 d) with no xz and yz correlation; null if C is singular or it is <= 0.

    ``d`` has x, y, z; ``cov`` the summed covariances xx, xy, yy, zz.
    """
    det = cov["xx"] * cov["yy"] - cov["xy"] * cov["xy"]
    plane = F.try_divide(
        cov["yy"] * d["x"] * d["x"] + cov["xx"] * d["y"] * d["y"] - 2 * cov["xy"] * d["x"] * d["y"], det
    )
    square = plane + F.try_divide(d["z"] * d["z"], cov["zz"])
    return F.when(square > 0, F.sqrt(square))


def residual(d: Mapping[str, Column]) -> Column:
    """Squared distance of two points."""
    return d["x"] * d["x"] + d["y"] * d["y"] + d["z"] * d["z"]


def weighted_residual(d: Mapping[str, Column], cov: Mapping[str, Column]) -> Column:
    """d' C^-1 d for a full 3x3 covariance (xx xy xz yy yz zz); 0 if it is singular."""
    a = cov["yy"] * cov["zz"] - cov["yz"] * cov["yz"]
    b = cov["xz"] * cov["yz"] - cov["xy"] * cov["zz"]
    c = cov["xy"] * cov["yz"] - cov["xz"] * cov["yy"]
    det = cov["xx"] * a + cov["xy"] * b + cov["xz"] * c
    e = cov["xx"] * cov["zz"] - cov["xz"] * cov["xz"]
    f = cov["xy"] * cov["xz"] - cov["xx"] * cov["yz"]
    g = cov["xx"] * cov["yy"] - cov["xy"] * cov["xy"]
    x, y, z = d["x"], d["y"], d["z"]
    form = a * x * x + e * y * y + g * z * z + 2 * (b * x * y + c * x * z + f * y * z)
    return F.coalesce(F.try_divide(form, det), F.lit(0.0))
