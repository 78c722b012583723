"""Particle identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import pid
from eventloom.functions.decays import MASSES
from eventloom.functions.energyloss import CHAMBER_CURVE as K
from eventloom.plans.domain import table
from eventloom.plans.registry import query, r6

C = F.col
SYSTEM, START = 80.0, [20.0 + 5 * i for i in range(10)]
PRIORS = {"electron": 0.1, "muon": -1.0, "pion": 1.0, "kaon": 0.3, "proton": 0.2}
TABLES = ("tracks_extra",)


def _each(template: str) -> str:
    return ", ".join(template.replace("{s}", s).replace("{m}", repr(MASSES[s])) for s in pid.SPECIES)


_BETA = "((p / {m}) / sqrt(1 + (p / {m}) * (p / {m})))"
_LOSS = (
    f"50 * ({K[1]!r} - pow({_BETA}, {K[3]!r}) - ln({K[2]!r} + pow(p / {{m}}, -{K[4]!r}))) * {K[0]!r} / pow({_BETA}, {K[3]!r})"
)
_START = "CASE " + " ".join(
    f"WHEN p > {e} THEN {20.0 + 5 * (i + 1)}" for i, e in reversed(list(enumerate(pid.START_TIME_EDGES[1:-1])))
) + " ELSE 20.0 END"
BASE_SQL = f"""b AS (SELECT event_idx, obj_id, inner_p AS p, tpc_signal AS signal, tpc_ncls, inner_p IS NOT NULL AND tpc_ncls > 0 AS has_loss,
    tof_signal - 9000 AS tof, length, inner_p IS NOT NULL AND length IS NOT NULL AS has_time FROM tracks_extra),
  e AS (SELECT *, {_each(_LOSS + ' AS e_{s}')}, {_each('length / 0.03 * sqrt(1 + {m} * {m} / (p * p)) AS t_{s}')}, {_START}::DOUBLE AS t0 FROM b),
  g AS (SELECT *, {_each('e_{s} * 0.07 AS se_{s}')}, {_each('sqrt(pow((0.008 + 0.008 * p + 0.002 * {m} / p) * t_{s} / (1 + p * p / ({m} * {m})), 2) + 1600 / (p * p) + 6400 + t0 * t0) AS st_{s}')} FROM e),
  n AS (SELECT *, {_each('CASE WHEN has_loss THEN (signal - e_{s}) / se_{s} END AS ne_{s}')}, {_each('CASE WHEN has_time THEN (tof - t_{s}) / st_{s} END AS nt_{s}')} FROM g),
  x AS (SELECT *, coalesce(has_loss AND least({_each('abs(ne_{s})')}) <= 5, false) AS ok_e, coalesce(has_time AND least({_each('abs(nt_{s})')}) <= 5, false) AS ok_t FROM n),
  l AS (SELECT *, {_each('CASE WHEN ok_e THEN exp(-0.5 * pow(least(abs(ne_{s}), 5), 2)) / se_{s} ELSE 0.2 END AS le_{s}')},
    {_each('CASE WHEN ok_t THEN exp(-0.5 * pow(least(abs(nt_{s}), 5), 2)) / st_{s} ELSE 0.2 END AS lt_{s}')} FROM x),
  c AS (SELECT *, {_each('le_{s} * coalesce(CASE WHEN has_time THEN lt_{s} END, 1) AS c_{s}')} FROM l)"""


def _stages(spark, sf):
    """Tracks with, per species, expectation, sigma, distance and likelihood of two detectors.

    Each stage is a projection over the one before; Catalyst merges what is cheap.
    """
    df = table(spark, sf, "tracks_extra").select(
        "event_idx",
        "obj_id",
        C("inner_p").alias("p"),
        C("tpc_signal").alias("signal"),
        "tpc_ncls",
        (C("inner_p").isNotNull() & (C("tpc_ncls") > 0)).alias("has_loss"),
        (C("tof_signal") - 9000).alias("tof"),
        "length",
        (C("inner_p").isNotNull() & C("length").isNotNull()).alias("has_time"),
    )
    p = C("p")
    df = _with(df, "e_", pid.expected_loss(p))
    df = _with(df, "t_", pid.expected_time(p, C("length")))
    df = _with(df, "se_", pid.loss_sigma(_get("e_"), C("tpc_ncls")))
    df = _with(df, "st_", pid.time_sigma(p, _get("t_"), SYSTEM, START))
    df = _with(df, "ne_", pid.n_sigma(C("signal"), _get("e_"), _get("se_"), C("has_loss")))
    df = _with(df, "nt_", pid.n_sigma(C("tof"), _get("t_"), _get("st_"), C("has_time")))
    df = _with(df, "le_", pid.likelihoods(_get("ne_"), _get("se_"), C("has_loss")))
    return _with(df, "lt_", pid.likelihoods(_get("nt_"), _get("st_"), C("has_time")))


def _with(df, prefix, values):
    return df.withColumns({f"{prefix}{s}": v for s, v in values.items()})


def _get(prefix):
    return {s: C(f"{prefix}{s}") for s in pid.SPECIES}


def _combined(df):
    in_time = {s: F.when(C("has_time"), C(f"lt_{s}")) for s in pid.SPECIES}
    return _with(df, "c_", pid.combined([_get("le_"), in_time]))


def _output(df, *prefixes):
    columns = [r6(C(f"{p}{s}")).alias(f"{p}{s}") for p in prefixes for s in pid.SPECIES]
    return df.select("event_idx", "obj_id", *columns)


def _sql(stage: str, *prefixes: str) -> str:
    columns = ", ".join(_each(f"r6({p}{{s}}) AS {p}{{s}}") for p in prefixes)
    return f"WITH {BASE_SQL} SELECT event_idx, obj_id, {columns} FROM {stage}"


@query("l01_expected_signal", _sql("e", "e_"), TABLES)
def expected_signal(spark, sf):
    return _output(_stages(spark, sf), "e_")


@query("l02_expected_sigma", _sql("g", "se_"), TABLES)
def expected_sigma(spark, sf):
    return _output(_stages(spark, sf), "se_")


@query("l03_n_sigma", _sql("n", "ne_", "nt_"), TABLES)
def number_of_sigmas(spark, sf):
    return _output(_stages(spark, sf), "ne_", "nt_")


@query("l04_time_sigma", _sql("g", "t_", "st_"), TABLES)
def time_sigma(spark, sf):
    return _output(_stages(spark, sf), "t_", "st_")


@query("l05_likelihoods", _sql("l", "le_", "lt_"), TABLES)
def likelihoods(spark, sf):
    return _output(_stages(spark, sf), "le_", "lt_")


@query("l06_combined_detectors", _sql("c", "c_"), TABLES)
def combined_detectors(spark, sf):
    return _output(_combined(_stages(spark, sf)), "c_")


_W = {s: max(PRIORS[s], 0.0) for s in pid.SPECIES}
_SUM = " + ".join(f"c_{s} * {_W[s]}" for s in pid.SPECIES)


@query(
    "l07_posterior",
    f"WITH {BASE_SQL}, t AS (SELECT *, {_SUM} AS total FROM c) SELECT event_idx, obj_id, "
    + ", ".join(f"CASE WHEN total > 0 THEN r6(c_{s} * {_W[s]} / total) ELSE -1 END AS post_{s}" for s in pid.SPECIES)
    + " FROM t",
    TABLES,
)
def posterior(spark, sf):
    df = _combined(_stages(spark, sf))
    return _output(_with(df, "post_", pid.posterior(_get("c_"), PRIORS)), "post_")


def _argmax(prefix: str) -> str:
    best = f"greatest({', '.join(f'{prefix}{s}' for s in pid.SPECIES)})"
    cases = " ".join(f"WHEN {prefix}{s} = {best} THEN '{s}'" for s in pid.SPECIES)
    return f"CASE WHEN {best} <= 0 THEN 'pion' {cases} END"


def _flat(prefix: str) -> str:
    return " AND ".join(f"{prefix}{a} = {prefix}{b}" for a, b in zip(pid.SPECIES, pid.SPECIES[1:]))


@query(
    "l08_most_probable",
    f"""WITH {BASE_SQL}, t AS (SELECT *, {', '.join(f'c_{s} * {_W[s]} AS w_{s}' for s in pid.SPECIES)} FROM c)
       SELECT event_idx, obj_id, {_argmax('w_')} AS species, CASE WHEN NOT ({_flat('le_')}) THEN {_argmax('le_')}
         WHEN NOT ({_flat('c_')}) THEN {_argmax('c_')} ELSE 'pion' END AS assigned FROM t""",
    TABLES,
)
def most_probable(spark, sf):
    df = _combined(_stages(spark, sf))
    weighted = {s: C(f"c_{s}") * _W[s] for s in pid.SPECIES}
    return df.select(
        "event_idx",
        "obj_id",
        pid.most_probable(weighted).alias("species"),
        pid.assigned(_get("le_"), _get("c_"), F.lit("pion")).alias("assigned"),
    )
