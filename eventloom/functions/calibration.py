"""Forward-calorimeter and beam quantities as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tower centres (cm), energy exponents, spectator correction.
TOWER_X = (-1.75, 1.75, -1.75, 1.75)
TOWER_Y = (-1.75, -1.75, 1.75, 1.75)
ION_EXPONENT, PROTON_EXPONENT = 0.395, 0.5
SPECTATOR = (1.89358, 0.71262, 0.71789)
# "not available" codes of the time sum and difference
TOO_LATE, FIXED_CABLING, UNMAPPED, MAPPED = 1000.0, 999.0, 998.0, 997.0

# Fixed values: (mass number, charge), nucleon mass, reference density and energy (GeV).
PROTON, LEAD = (1, 1), (208, 82)
NUCLEON_MASS = 0.94
REFERENCES = {"pp": (5.3, 13.0e3), "mixed": (16.3, 5.02e3), "ions": (600.0, 5.02e3)}
DENSITY_EXPONENT = 0.103


def neutron_centroid(towers: Column, energy: Column, beam_energy: float | None = None) -> tuple[Column, Column]:
    """(x, y) of the shower centroid over four towers; null if none has energy.

    With a beam energy the exponent and the spectator correction of ion beams apply.
    """
    exponent = PROTON_EXPONENT if beam_energy is None else ION_EXPONENT
    weights = F.transform(towers, lambda e: F.when(e > 0, F.pow(e, F.lit(exponent))).otherwise(0.0))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    def centre(corners: tuple) -> Column:
        at = F.array(*[F.lit(c) for c in corners])
        value = F.try_divide(total(F.zip_with(weights, at, lambda w, c: w * c)), total(weights))
        if beam_energy is None:
            return value
        a, b, c = SPECTATOR
        return value * (a - b / (energy / beam_energy + c))

    return centre(TOWER_X), centre(TOWER_Y)


def neutron_times(raw_c, raw_a, time_c, time_a, corrected, cabling) -> tuple[Column, Column]:
    """(sum, difference) of the two sides' times, or a code telling why there is none.

    ``cabling``: 0 fixed channels, 1 mapping not set, 2 channels from the mapping.
    The difference is side C minus side A, and A minus C with a mapping.
    """
    both = (raw_c != 0) & (raw_a != 0)

    def coded(value: Column) -> Column:
        code = F.when(cabling == 0, FIXED_CABLING).when(cabling == 1, UNMAPPED).otherwise(MAPPED)
        return F.when(~corrected, F.lit(TOO_LATE)).when(both, value).otherwise(code)

    diff = F.when(cabling == 2, time_a - time_c).otherwise(time_c - time_a)
    return coded(time_c + time_a), coded(diff)


def beam_species(beam_type: Column) -> Column:
    """pp, ions, p_ion, ion_p, or null, from a free-form beam name."""
    text = F.lower(beam_type)
    proton, ion = "(proton|p)", "(lead|pb|ion|a)"
    return (
        F.when(text.rlike(rf"{ion}\s*-?\s*\1"), "ions")
        .when(text.rlike(rf"{proton}\s*-?\s*\1($|[^a-z])"), "pp")
        .when(text.rlike(rf"{proton}\s*-?\s*{ion}"), "p_ion")
        .when(text.rlike(rf"{ion}\s*-?\s*{proton}"), "ion_p")
    )


def beam_scale(beam_type: Column, beam_energy: Column) -> tuple[Column, Column]:
    """(centre-of-mass energy, charged density relative to the pp reference).

    The energy is per charge; unknown species scale by 1.
    """
    species = beam_species(beam_type)
    e_ion = beam_energy * LEAD[1] / LEAD[0]
    m2 = NUCLEON_MASS**2
    p_proton, p_ion = F.sqrt(beam_energy * beam_energy - m2), F.sqrt(e_ion * e_ion - m2)
    mixed = F.sqrt(2 * m2 + 2 * beam_energy * e_ion * (1 + p_proton * p_ion / (beam_energy * e_ion)))
    asymmetric = species.isin("p_ion", "ion_p")
    sqrts = F.when(asymmetric, mixed).otherwise(2 * beam_energy)

    def relative(kind: str) -> Column:
        density, reference = REFERENCES[kind]
        return density * F.pow(sqrts / reference, F.lit(DENSITY_EXPONENT)) / REFERENCES["pp"][0]

    scale = (
        F.when(species == "pp", relative("pp"))
        .when(species == "ions", relative("ions"))
        .when(asymmetric, relative("mixed"))
        .otherwise(F.lit(1.0))
    )
    return sqrts, scale
