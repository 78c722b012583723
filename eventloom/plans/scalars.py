"""Scalar functions, sorting and concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import bunchmask, clocks, decays, energyloss, pid
from eventloom.operators import ancestry, tables
from eventloom.operators.ordered import numbered
from eventloom.plans.derived import decays as decay_table
from eventloom.plans.domain import base, table
from eventloom.plans.registry import query, r6
from eventloom.plans.sources import nested_cells

C = F.col


# --- sorting -------------------------------------------------------------------


@query(
    "g01_cells_by_number",
    """SELECT file_id, event_idx, obj_id, cell_number,
         row_number() OVER (PARTITION BY file_id, event_idx ORDER BY cell_number, obj_id) AS place FROM cells""",
    ("cells",),
)
def cells_by_number(spark, sf):
    """Place of each cell of a nested event in the order of the cell numbers.

    An event has any number of cells, spread over any number of records, so the sorted cells are rows.
    """
    cells = nested_cells(spark, sf, "cell_number").select(*tables.EVENT, F.explode("cells").alias("c"))
    cells = cells.select(*tables.EVENT, "c.obj_id", "c.cell_number")
    return numbered(cells, tables.EVENT, F.floor(C("cell_number") / 4096), ["cell_number", "obj_id"], "place")


@query(
    "g02_records_by_time",
    "SELECT run, rec, period, orbit, bunch_cross FROM counters ORDER BY run, period, orbit, bunch_cross",
    ("counters",),
)
def records_by_time(spark, sf):
    key = clocks.time_key(C("period"), C("orbit"), C("bunch_cross"))
    df = table(spark, sf, "counters").select("run", "rec", "period", "orbit", "bunch_cross")
    return df.orderBy("run", key)


@query(
    "g03_error_logs_by_event",
    "SELECT file_id, event_number, ddl_id, seq FROM error_log ORDER BY event_number, ddl_id, seq",
    ("error_log",),
)
def error_logs_by_event(spark, sf):
    df = table(spark, sf, "error_log").select("file_id", "event_number", "ddl_id", "seq")
    return df.orderBy("event_number", "ddl_id", "seq")


@query(
    "g04_points_sorted",
    """SELECT vec_id, list_sort(list_transform(embedding, lambda v: v::DOUBLE)) AS up, list_reverse_sort(list_transform(embedding, lambda v: v::DOUBLE)) AS down FROM embeddings""",
)
def points_sorted(spark, sf):
    values = C("embedding").cast("array<double>")
    return base(spark, sf, "embeddings").select(
        "vec_id", F.sort_array(values).alias("up"), F.sort_array(values, asc=False).alias("down")
    )


@query(
    "g05_top_by_score",
    """WITH s AS (SELECT p_partkey, p_size % 7 AS electron, p_partkey % 5 AS muon, p_size % 3 AS pion, p_partkey % 4 AS kaon, p_partkey % 6 AS proton FROM part),
       m AS (SELECT *, greatest(electron, muon, pion, kaon, proton) AS best FROM s)
       SELECT p_partkey AS entry, CASE WHEN best <= 0 THEN 'pion' WHEN electron = best THEN 'electron' WHEN muon = best THEN 'muon' WHEN pion = best THEN 'pion'
         WHEN kaon = best THEN 'kaon' ELSE 'proton' END AS species FROM m""",
)
def top_by_score(spark, sf):
    scores = {
        "electron": C("p_size") % 7,
        "muon": C("p_partkey") % 5,
        "pion": C("p_size") % 3,
        "kaon": C("p_partkey") % 4,
        "proton": C("p_partkey") % 6,
    }
    df = base(spark, sf, "part")
    return df.select(C("p_partkey").alias("entry"), pid.most_probable({s: v.cast("double") for s, v in scores.items()}).alias("species"))


# --- set operations -------------------------------------------------------------


@query(
    "h01_concat",
    """SELECT file_id, event_idx, obj_id, chi2 FROM muons UNION ALL SELECT file_id, event_idx, obj_id, its_chi2 FROM tracks_extra""",
    ("muons", "tracks_extra"),
)
def concat(spark, sf):
    first = table(spark, sf, "muons").select(*tables.OBJECT, "chi2", "nhit")
    second = table(spark, sf, "tracks_extra").select("flags", C("its_chi2").alias("chi2"), *tables.OBJECT)
    return tables.concat(first, second)


@query(
    "h02_concat_many",
    """SELECT event_idx, obj_id FROM muons UNION ALL SELECT event_idx, obj_id FROM cells UNION ALL SELECT event_idx, obj_id FROM tracks
       UNION ALL SELECT event_idx, obj_id FROM vertices""",
    ("muons", "cells", "tracks", "vertices"),
)
def concat_many(spark, sf):
    names = ("muons", "cells", "tracks", "vertices")
    parts = [table(spark, sf, n) for n in names]
    # columns of one table only fall away step by step
    return tables.concat_all([parts[0].select("event_idx", "obj_id", "chi2"), *parts[1:]])


# --- functions --------------------------------------------------------------------

_K = energyloss.CHAMBER_CURVE
_BETA = "(bg / sqrt(1 + bg * bg))"


@query(
    "i01_energy_loss_curve",
    f"""WITH b AS (SELECT event_idx, obj_id, 0.1 + tpc_signal / 10 AS bg FROM tracks_extra)
       SELECT event_idx, obj_id, r6(({_K[1]!r} - pow({_BETA}, {_K[3]!r}) - ln({_K[2]!r} + pow(bg, -{_K[4]!r}))) * {_K[0]!r} / pow({_BETA}, {_K[3]!r})) AS loss FROM b""",
    ("tracks_extra",),
)
def energy_loss_curve(spark, sf):
    bg = F.lit(0.1) + C("tpc_signal") / 10
    return table(spark, sf, "tracks_extra").select("event_idx", "obj_id", r6(energyloss.curve_five(bg)).alias("loss"))


def _material(rho, j0, j1, mi, za) -> str:
    low, high = j0 * 2.303, j1 * 2.303
    lhw = f"ln(28.816e-9 * sqrt({rho}::DOUBLE * {za}) / {mi}::DOUBLE)"
    d2 = f"""CASE WHEN ln(bg) > {high!r} THEN {lhw} + ln(bg) - 0.5 WHEN ln(bg) > {low!r} THEN {lhw} + ln(bg) - 0.5
      + (0.5 - {lhw} - {low!r}) * pow(({high!r} - ln(bg)) / ({high!r} - {low!r}), 3) ELSE 0 END"""
    return f"0.307075e-3 * {za} * (1 + bg * bg) / (bg * bg) * (0.5 * ln(pow(2 * 0.511e-3 * bg * bg / {mi}::DOUBLE, 2)) - bg * bg / (1 + bg * bg) - {d2}) * 1000"


@query(
    "i02_energy_loss_materials",
    f"""WITH b AS (SELECT event_idx, obj_id, 0.1 + tpc_signal * tpc_signal / 100 AS bg FROM tracks_extra)
       SELECT event_idx, obj_id, r6({_material(*energyloss.SOLID)}) AS solid, r6({_material(*energyloss.GAS)}) AS gas FROM b""",
    ("tracks_extra",),
)
def energy_loss_materials(spark, sf):
    bg = C("bg")
    df = table(spark, sf, "tracks_extra").withColumn("bg", 0.1 + C("tpc_signal") * C("tpc_signal") / 100)
    return df.select(
        "event_idx",
        "obj_id",
        r6(energyloss.curve_solid(bg) * 1000).alias("solid"),
        r6(energyloss.curve_gas(bg) * 1000).alias("gas"),
    )


@query(
    "i03_fast_erfc",
    """WITH v AS (SELECT event_id, (value - 50) / 20 AS x FROM events),
       p AS (SELECT event_id, x, 1 + abs(x) * (0.278393 + abs(x) * (0.230389 + abs(x) * (0.000972 + abs(x) * 0.078108))) AS p FROM v)
       SELECT event_id, r6(CASE WHEN x >= 0 THEN 1 / pow(p, 4) ELSE 2 - 1 / pow(p, 4) END) AS erfc FROM p""",
)
def fast_erfc(spark, sf):
    x = (C("value") - 50) / 20
    return base(spark, sf, "events").select("event_id", r6(energyloss.erfc_rational(x)).alias("erfc"))


@query(
    "i04_bunch_mask",
    """SELECT p_partkey AS mask_id, 3564 - (p_size + 4 * (p_size % 9 + 1) * 3) AS n_unmasked, p_size % 2 = 0 AS first_open FROM part
       WHERE p_partkey % 50 <> 49""",
)
def bunch_mask(spark, sf):
    """Masks written in the compact notation and decoded; one in fifty is malformed."""
    # the leading letters, four groups of three masked and two open each, and open ones up to the end
    lead = F.when(C("p_size") % 2 == 0, F.concat(F.lit("L "), "p_size", F.lit("H "))).otherwise(
        F.concat("p_size", F.lit("H L "))
    )
    group = F.concat(F.lit("4("), C("p_size") % 9 + 1, F.lit("(3HL) L)"))
    used = C("p_size") + 1 + 4 * ((C("p_size") % 9 + 1) * 4 + 1)
    tail = F.concat(F.lit(" "), (3564 - used).cast("string"), F.when(C("p_partkey") % 50 == 49, "X").otherwise("L"))
    masks = base(spark, sf, "part").select(C("p_partkey").alias("mask_id"), F.concat(lead, group, tail).alias("mask"))
    # decoding costs far more than reading, so a small file is no single task
    masks = masks.repartition(4 * spark.sparkContext.defaultParallelism)
    decoded = masks.select("mask_id", bunchmask.unmasked(C("mask")).alias("open")).where("open IS NOT NULL")
    return decoded.select(
        "mask_id", F.size("open").cast("int").alias("n_unmasked"), (F.get("open", F.lit(0)) == 0).alias("first_open")
    )


@query(
    "i05_time_stamp_key",
    """SELECT run, rec, CAST(floor((us * 1000.0::DOUBLE) / 25 + 0.5) AS BIGINT) AS crossing, rank() OVER (PARTITION BY run ORDER BY period, orbit, bunch_cross) = 1 AS is_first FROM counters""",
    ("counters",),
)
def time_stamp_key(spark, sf):
    df = table(spark, sf, "counters")
    key = clocks.time_key(C("period"), C("orbit"), C("bunch_cross"))
    first = df.groupBy("run").agg(F.min(key).alias("first_key"))
    crossing = clocks.crossing_from_time(F.floor(C("us") / 1000000), C("us") % 1000000)
    return df.join(first, "run").select("run", "rec", crossing.alias("crossing"), (key == C("first_key")).alias("is_first"))


@query(
    "i07_mass_margin",
    """WITH p AS (SELECT event_idx, sqrt(pow(ppx + npx, 2) + pow(ppy + npy, 2)) AS pt, CASE event_idx % 3 WHEN 0 THEN 5.0 WHEN 1 THEN -2.0 ELSE 0.0005 END::DOUBLE AS b FROM decays)
       SELECT event_idx, r6(5 * CASE WHEN abs(b) > 1e-3 THEN 5.00668 / abs(b) ELSE 1 END * 0.1 * (1 + 0.2 * pt) + 0.05) AS margin FROM p""",
    ("decays",),
)
def mass_margin(spark, sf):
    px, py = C("ppx") + C("npx"), C("ppy") + C("npy")
    field = F.when(C("event_idx") % 3 == 0, 5.0).when(C("event_idx") % 3 == 1, -2.0).otherwise(0.0005)
    margin = decays.mass_margin(F.sqrt(px * px + py * py), field, 5, 0.1, 1, 0.2, 0.05)
    return decay_table(spark, sf).select("event_idx", r6(margin).alias("margin"))


_STABLE = ", ".join(str(s) for s in ancestry.STABLE)


@query(
    "i08_stable_particles",
    f"""SELECT event_idx, idx, abs(pdg) > 1000000000 OR abs(pdg) IN ({_STABLE}) AS stable, CAST(substr(CAST(abs(pdg) AS VARCHAR), 1, 1) AS INT) AS digit FROM particles""",
    ("particles",),
)
def stable_particles(spark, sf):
    return table(spark, sf, "particles").select(
        "event_idx", "idx", ancestry.is_stable(F.abs("pdg")).alias("stable"), ancestry.leading_digit(C("pdg")).alias("digit")
    )


@query(
    "i09_particle_masses",
    """SELECT event_idx, idx, CASE abs(pdg) WHEN 11 THEN 0.000510998928 WHEN 13 THEN 0.1056583715 WHEN 211 THEN 0.13957018 WHEN 321 THEN 0.493677
         WHEN 2212 THEN 0.938272046 WHEN 3122 THEN 1.115683 END::DOUBLE AS mass FROM particles""",
    ("particles",),
)
def particle_masses(spark, sf):
    return table(spark, sf, "particles").select("event_idx", "idx", decays.mass_of(C("pdg")).alias("mass"))
