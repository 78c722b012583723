"""Energy-loss curves and small numeric functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (density, first and second junction of the density effect,
# mean excitation energy in GeV, mean Z/A).
SOLID = (2.33, 0.20, 3.00, 173e-9, 0.49848)
GAS = (0.9e-3, 2.0, 4.0, 140e-9, 0.49555)

# Fixed values of the five-parameter curve, in units of its minimum.
CHAMBER_CURVE = (0.76176e-1, 10.632, 0.13279e-4, 1.8631, 1.9479)


def curve_five(bg: Column, k1=CHAMBER_CURVE[0], k2=CHAMBER_CURVE[1], k3=CHAMBER_CURVE[2],
               k4=CHAMBER_CURVE[3], k5=CHAMBER_CURVE[4]) -> Column:
    """Five-parameter energy loss over beta*gamma, 1 at the minimum."""
    beta_k4 = F.pow(bg / F.sqrt(1 + bg * bg), F.lit(k4))
    return (k2 - beta_k4 - F.log(k3 + F.pow(bg, F.lit(-k5)))) * k1 / beta_k4


def curve_material(bg: Column, density: float, junction0: float, junction1: float,
                   excitation: float, z_over_a: float) -> Column:
    """Energy loss (GeV per g/cm2) in a material, with the density effect."""
    electron, constant = 0.511e-3, 0.307075e-3
    low, high = junction0 * 2.303, junction1 * 2.303
    bg2 = bg * bg
    x = F.log(bg)
    plasma = F.log(F.lit(28.816e-9) * F.sqrt(F.lit(density * z_over_a)) / excitation)
    left = (high - x) / (high - low)
    full = plasma + x - 0.5
    density_effect = (
        F.when(x > high, full)
        .when(x > low, full + (0.5 - plasma - low) * left * left * left)
        .otherwise(0.0)
    )
    transfer = 2 * electron * bg2
    bracket = 0.5 * F.log(transfer * transfer / (excitation * excitation)) - bg2 / (1 + bg2)
    return constant * z_over_a * (1 + bg2) / bg2 * (bracket - density_effect)


def curve_solid(bg: Column) -> Column:
    return curve_material(bg, *SOLID)


def curve_gas(bg: Column) -> Column:
    return curve_material(bg, *GAS)


def erfc_rational(x: Column) -> Column:
    """Complementary error function by the published four-term rational form (7.1.27)."""
    z = F.abs(x)
    poly = 1 + z * (0.278393 + z * (0.230389 + z * (0.000972 + z * 0.078108)))
    tail = 1 / (poly * poly * poly * poly)
    return F.when(x >= 0, tail).otherwise(2 - tail)
