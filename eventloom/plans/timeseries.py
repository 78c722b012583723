"""Counter, sensor and interaction time series; row windows and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import padrows
from eventloom.operators import counters, machine, series, spacing
from eventloom.operators.ordered import blocked
from eventloom.plans.domain import base, table
from eventloom.plans.joins import BUNCHES_SQL, bunch_records
from eventloom.plans.registry import query, r6

C = F.col
LEVELS = [f"c{i}" for i in range(6)]
TIME = ["period", "orbit", "bunch_cross"]
BLOCK = "period"

_LAGS = ", ".join(f"lag({c}) OVER w AS p{c}" for c in LEVELS)
_NEXT = ", ".join(
    f"sum(CASE WHEN {c} < p{c} AND p{c} - {c} > 1000000000 THEN 1 ELSE 0 END) OVER w2 AS o{c}, "
    f"CASE WHEN {c} < p{c} AND p{c} - {c} > 1000000000 THEN 1 ELSE 0 END AS n{c}"
    for c in LEVELS
)
_TOTALS = ", ".join(
    f"CAST({c} + o{c} * 4294967296 AS BIGINT) AS {c}_total, CAST(p{c} + (o{c} - n{c}) * 4294967296 AS BIGINT) AS {c}_before"
    for c in LEVELS
)
CORRECTED_SQL = f"""l AS (SELECT *, {_LAGS} FROM counters WINDOW w AS (PARTITION BY run ORDER BY period, orbit, bunch_cross, rec)),
  s AS (SELECT *, {_NEXT} FROM l WINDOW w2 AS (PARTITION BY run ORDER BY period, orbit, bunch_cross, rec ROWS UNBOUNDED PRECEDING)),
  cc AS (SELECT run, rec, us, orbit_abs, {_TOTALS} FROM s)"""


def corrected(spark, sf):
    return counters.corrected(table(spark, sf, "counters"), ["run"], [*TIME, "rec"], C(BLOCK), LEVELS, ["orbit_abs"])


@query(
    "f01_overflow_correction",
    f"WITH {CORRECTED_SQL} SELECT run, rec, {', '.join(f'{c}_total' for c in LEVELS)} FROM cc",
    ("counters",),
)
def overflow_correction(spark, sf):
    return corrected(spark, sf).select("run", "rec", *[f"{c}_total" for c in LEVELS])


def _growth(i: int) -> str:
    return f"(c{i}_total - c{i}_before)"


_DECREASED = " OR ".join(f"{_growth(i)} < 0" for i in range(6))
_EXCEEDED = " OR ".join(f"{_growth(i + 1)} - {_growth(i)} {'> 512' if i == 1 else '>= 16'}" for i in range(5))
_CODE = f"CASE WHEN c0_before IS NULL THEN 0 WHEN {_DECREASED} THEN 2 WHEN {_EXCEEDED} THEN 1 ELSE 0 END"


@query(
    "f02_consistency_check",
    f"""WITH {CORRECTED_SQL}, k AS (SELECT run, rec, {_CODE} AS code FROM cc)
       SELECT run, rec, code, max(CASE WHEN code <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY run) = 0 AS run_good FROM k""",
    ("counters",),
)
def consistency_check(spark, sf):
    df = corrected(spark, sf).withColumn("code", counters.verdict(LEVELS, TIME)).select("run", "rec", "code")
    verdicts = df.groupBy("run").agg((F.max(F.when(C("code") != 0, 1).otherwise(0)) == 0).alias("run_good"))
    return df.join(verdicts, "run")


@query(
    "f02_consistent_runs",
    f"""WITH {CORRECTED_SQL}, k AS (SELECT run, rec, CASE WHEN c0_before IS NULL THEN 0
           WHEN {_growth(0)} < 0 OR {_growth(5)} < 0 THEN 2 WHEN {_growth(5)} - {_growth(0)} >= 16 THEN 1 ELSE 0 END AS code FROM cc)
       SELECT run, rec FROM k WHERE run NOT IN (SELECT run FROM k WHERE code <> 0)""",
    ("counters",),
)
def consistent_runs(spark, sf):
    checked = corrected(spark, sf).withColumn("code", counters.verdict(["c0", "c5"], TIME))
    return counters.consistent_runs(checked, ["run"]).select("run", "rec")


INTERVALS_SQL = f"""{CORRECTED_SQL},
  iv AS (SELECT *, lead(orbit_abs) OVER w - orbit_abs AS d_orbit, lead(c2_total) OVER w - c2_total AS d_l0,
    lead(c5_total) OVER w - c5_total AS d_l2, min(orbit_abs) OVER (PARTITION BY run) AS first_orbit
    FROM cc WINDOW w AS (PARTITION BY run ORDER BY orbit_abs, rec))"""


def _intervals(spark, sf):
    return counters.intervals(corrected(spark, sf), ["run"], "orbit_abs", {"l0": "c2", "l2": "c5"})


@query(
    "f03_elapsed_orbits",
    f"""WITH {INTERVALS_SQL} SELECT run, rec, d_orbit, r6(d_orbit * 89.1::DOUBLE * 1e-6) AS seconds FROM iv WHERE d_orbit IS NOT NULL""",
    ("counters",),
)
def elapsed_orbits(spark, sf):
    return _intervals(spark, sf).select(
        "run", "rec", C("d_time").alias("d_orbit"), r6(counters.seconds(C("d_time"))).alias("seconds")
    )


@query(
    "f04_rate_and_error",
    f"""WITH {INTERVALS_SQL}, t AS (SELECT *, d_orbit * 89.1::DOUBLE * 1e-6 AS dt FROM iv WHERE d_orbit > 0 AND d_l0 >= 0)
       SELECT run, rec, r6(d_l0 / dt) AS rate, r6(sqrt(d_l0) / dt) AS error, r6(d_l0 / dt / 24) AS rate_per_bunch, r6(sqrt(d_l0) / dt / 24) AS error_per_bunch FROM t""",
    ("counters",),
)
def rate_and_error(spark, sf):
    df = _intervals(spark, sf).where("d_time > 0 AND d_l0 >= 0")
    value, error = counters.rate(C("d_l0"), counters.seconds(C("d_time")))
    return df.select(
        "run",
        "rec",
        r6(value).alias("rate"),
        r6(error).alias("error"),
        r6(value / 24).alias("rate_per_bunch"),
        r6(error / 24).alias("error_per_bunch"),
    )


@query(
    "f05_level_ratio",
    f"""WITH {INTERVALS_SQL}, t AS (SELECT run, rec, d_l0::DOUBLE AS l0, d_l2::DOUBLE AS l2 FROM iv WHERE d_l0 > 0)
       SELECT run, rec, r6(l2 / l0) AS ratio, r6(sqrt(abs(l2 - l2 * l2 / l0)) / l0) AS error FROM t""",
    ("counters",),
)
def level_ratio(spark, sf):
    value, error = counters.ratio(C("d_l2"), C("d_l0"))
    return _intervals(spark, sf).where("d_l0 > 0").select("run", "rec", r6(value).alias("ratio"), r6(error).alias("error"))


@query(
    "f06_whole_run_rate",
    f"""WITH {CORRECTED_SQL},
       d AS (SELECT run, count(*) AS n, max(orbit_abs) - min(orbit_abs) AS o, arg_max(c2_total, rec) - arg_min(c2_total, rec) AS l0,
         arg_max(c5_total, rec) - arg_min(c5_total, rec) AS l2 FROM cc GROUP BY run)
       SELECT run, r6(l0 / (o * 89.1::DOUBLE * 1e-6)) AS rate, r6(l2 / l0) AS ratio FROM d WHERE n >= 4""",
    ("counters",),
)
def whole_run_rate(spark, sf):
    deltas = counters.whole_run_delta(
        corrected(spark, sf), ["run"], ["orbit_abs", "rec"], ["orbit_abs", "c2_total", "c5_total"]
    ).where("n_records >= 4")
    value, _ = counters.rate(C("d_c2_total"), counters.seconds(C("d_orbit_abs")))
    share, _ = counters.ratio(C("d_c5_total"), C("d_c2_total"))
    return deltas.select("run", r6(value).alias("rate"), r6(share).alias("ratio"))


@query(
    "f07_rate_curve",
    f"""WITH {INTERVALS_SQL}, t AS (SELECT *, d_orbit * 89.1::DOUBLE * 1e-6 AS dt, (orbit_abs - first_orbit) * 89.1::DOUBLE * 1e-6 AS t0 FROM iv WHERE d_orbit IS NOT NULL)
       SELECT run, rec, r6(t0 + dt / 2) AS time, r6(dt / 2) AS half_width,
         CASE WHEN d_orbit > 0 AND d_l0 >= 0 THEN r6(d_l0 / dt) ELSE -1 END AS rate, CASE WHEN d_l0 > 0 THEN r6(d_l2 / d_l0) ELSE -1 END AS ratio FROM t""",
    ("counters",),
)
def rate_curve(spark, sf):
    df = _intervals(spark, sf)
    first = table(spark, sf, "counters").groupBy("run").agg(F.min("orbit_abs").alias("first_orbit"))
    dt = counters.seconds(C("d_time"))
    t0 = counters.seconds(C("start") - C("first_orbit"))
    time, half = counters.curve_point(t0, dt, F.lit(0.0))
    value, _ = counters.rate(C("d_l0"), dt)
    share, _ = counters.ratio(C("d_l2"), C("d_l0"))
    return df.join(first, "run").select(
        "run",
        "rec",
        r6(time).alias("time"),
        r6(half).alias("half_width"),
        F.when((C("d_time") > 0) & (C("d_l0") >= 0), r6(value)).otherwise(-1.0).alias("rate"),
        F.when(C("d_l0") > 0, r6(share)).otherwise(-1.0).alias("ratio"),
    )


@query(
    "f08_pile_up",
    f"""WITH {INTERVALS_SQL},
       t AS (SELECT run, rec, d_l0::DOUBLE AS b, d_l2::DOUBLE / 10 AS ac, d_orbit * 900.0::DOUBLE AS nb, d_orbit * 700.0::DOUBLE AS nac FROM iv
         WHERE d_orbit > 0 AND d_l0 > 0 AND d_l2 >= 0),
       p AS (SELECT *, b / nb AS pb, ac / nac AS pac FROM t)
       SELECT run, rec, r6((ln(1 - pac) - ln(1 - pb)) / 0.8) AS mu,
         r6(sqrt(pb / ((1 - pb) * nb) + pac / ((1 - pac) * nac) + ((ln(1 - pac) - ln(1 - pb)) / 0.8) ** 2 * (0.05 / 0.8) ** 2)) AS error,
         r6(-ln(1 - pb) / 0.8) AS mu_plain FROM p""",
    ("counters",),
)
def pile_up(spark, sf):
    df = _intervals(spark, sf).where("d_time > 0 AND d_l0 > 0 AND d_l2 >= 0")
    trials, other = C("d_time") * F.lit(900.0), C("d_time") * F.lit(700.0)
    mu, error = counters.pile_up(C("d_l0"), trials, C("d_l2") / 10, other, 0.8, 0.05)
    plain, _ = counters.pile_up(C("d_l0"), trials, F.lit(0), F.lit(0.0), 0.8)
    return df.select("run", "rec", r6(mu).alias("mu"), r6(error).alias("error"), r6(plain).alias("mu_plain"))


@query(
    "f09_luminosity",
    """WITH n AS (SELECT run, rec, us, c3, lead(c3) OVER w AS next_c, lead(us) OVER w AS next_us FROM counters
         WINDOW w AS (PARTITION BY run ORDER BY us, rec)),
       i AS (SELECT *, CASE WHEN next_c >= c3 THEN next_c - c3 ELSE next_c - c3 + 4294967296 END AS cnt, (next_us - us) / 1e6 AS dt FROM n WHERE next_us IS NOT NULL),
       m AS (SELECT *, cnt / (dt * 11245.0 * 40) AS f FROM i WHERE dt >= 1e-6),
       g AS (SELECT run FROM counters GROUP BY run HAVING max(us) - min(us) >= 1000000),
       l AS (SELECT *, CASE WHEN f < 1 THEN -ln(1 - f) END AS mu FROM m WHERE run IN (SELECT run FROM g))
       SELECT run, rec, r6(mu) AS mu, r6(mu * 11245.0 * 40 / 4.6) AS lumi,
         r6(CASE WHEN cnt > 0 THEN mu * 11245.0 * 40 / 4.6 / sqrt(cnt) WHEN mu IS NOT NULL THEN 0 END) AS error,
         r6(avg(mu) OVER (PARTITION BY run) / 0.9) AS run_mu FROM l""",
    ("counters",),
)
def luminosity(spark, sf):
    rows = table(spark, sf, "counters").select("run", "rec", "us", "period", "c3")
    linked = blocked(
        rows, ["run"], C(BLOCK), ["us", "rec"], lead={"next_c": C("c3"), "next_us": C("us")}
    ).where("next_us IS NOT NULL")
    lasting = rows.groupBy("run").agg((F.max("us") - F.min("us")).alias("span")).where("span >= 1000000").select("run")
    duration = (C("next_us") - C("us")) / F.lit(1e6)
    counts = counters.since_last(C("next_c"), C("c3"))
    values = counters.luminosity(counts, duration, 40, 4.6)
    points = (
        linked.join(lasting, "run", "left_semi")
        .where(duration >= 1e-6)
        .select("run", "rec", *[v.alias(n) for n, v in values.items()])
    )
    mean = points.groupBy("run").agg((F.avg("mu") / 0.9).alias("run_mu"))
    return points.join(mean, "run").select("run", "rec", *[r6(C(n)).alias(n) for n in ("mu", "lumi", "error", "run_mu")])


# deliveries: the records of four beams
_GAP = 1800


@query(
    "f10_delivered_luminosity",
    f"""WITH RECURSIVE d AS (SELECT run % 4 AS fill, rec, CAST(floor(us / 1e6) AS BIGINT) AS sec, us / 1e6 * 0.5 + rec % 7 AS integral FROM counters WHERE abs(us / 1e6 * 0.5 + rec % 7) >= 1e-9),
       k AS (SELECT fill, min(sec) AS sec FROM d GROUP BY fill
         UNION ALL SELECT k.fill, (SELECT min(d.sec) FROM d WHERE d.fill = k.fill AND d.sec >= k.sec + {_GAP}) FROM k WHERE k.sec IS NOT NULL),
       a AS (SELECT d.fill, d.sec, min(rec) AS rec, arg_min(integral, rec) AS integral FROM d JOIN k ON d.fill = k.fill AND d.sec = k.sec GROUP BY d.fill, d.sec),
       p AS (SELECT *, lag(sec) OVER w AS psec, lag(integral) OVER w AS pint FROM a WINDOW w AS (PARTITION BY fill ORDER BY sec))
       SELECT fill, rec, psec + (sec - psec) / 2 AS time, r6((integral - pint) / (sec - psec) * 1e6 * 2.0) AS lumi FROM p WHERE psec IS NOT NULL""",
    ("counters",),
)
def delivered_luminosity(spark, sf):
    rows = table(spark, sf, "counters").select(
        (C("run") % 4).alias("fill"),
        "rec",
        (C("us") / F.lit(1e6)).alias("t"),
        (C("us") / F.lit(1e6) * 0.5 + C("rec") % 7).alias("integral"),
    )
    found = spacing.delivered_luminosity(rows, ["fill"], 2.0, block_width=_GAP * 48, gap=_GAP)
    return found.select("fill", "rec", "time", r6(C("lumi")).alias("lumi"))


@query("f11_instantaneous_luminosity", "SELECT event_id, value * 1e3 * 0.5 AS lumi FROM events")
def instantaneous_luminosity(spark, sf):
    lumi = spacing.instantaneous_luminosity(C("value"), 0.5)
    return base(spark, sf, "events").select("event_id", lumi.alias("lumi"))


@query(
    "f12_changes_only",
    """WITH l AS (SELECT run, rec, kind, lag(kind) OVER w AS p, lag(rec) OVER w AS pr FROM crossings WINDOW w AS (PARTITION BY run ORDER BY orbit_abs, rec))
       SELECT run, rec, kind FROM l WHERE pr IS NULL OR kind <> p""",
    ("crossings",),
)
def changes_only(spark, sf):
    rows = table(spark, sf, "crossings").select("run", "rec", "kind", "orbit_abs")
    block = F.shiftright("orbit_abs", 24)
    return machine.changes_only(rows, ["run"], ["orbit_abs", "rec"], block, "kind").select("run", "rec", "kind")


@query(
    "f12_bunch_configurations",
    """WITH b AS (SELECT run % 8 AS fill, orbit_abs, rec, CASE kind WHEN 'click' THEN [1, 101, 201] WHEN 'view' THEN [1, 101] WHEN 'error' THEN [1, 101, 201] ELSE [] END AS conf FROM crossings),
       l AS (SELECT *, lag(conf) OVER w AS p, lag(rec) OVER w AS pr FROM b WINDOW w AS (PARTITION BY fill ORDER BY orbit_abs, rec))
       SELECT fill, rec, len(conf) AS n_bunches FROM l WHERE pr IS NULL OR conf <> p""",
    ("crossings",),
)
def bunch_configurations(spark, sf):
    zero_padded = (
        F.when(C("kind").isin("click", "error"), F.array(*[F.lit(v) for v in (1, 101, 201, 0, 0)]))
        .when(C("kind") == "view", F.array(*[F.lit(v) for v in (1, 101, 0, 0, 0)]))
        .otherwise(F.array(*[F.lit(v) for v in (0, 0, 0, 0, 0)]))
    )
    rows = table(spark, sf, "crossings").select(
        (C("run") % 8).alias("fill"), "rec", "orbit_abs", machine.trimmed(zero_padded).alias("conf")
    )
    kept = machine.changes_only(rows, ["fill"], ["orbit_abs", "rec"], F.shiftright("orbit_abs", 24), "conf")
    return kept.select("fill", "rec", F.size("conf").cast("bigint").alias("n_bunches"))


@query(
    "f13_run_window",
    """WITH r AS (SELECT run % 16 AS sensor, rec, us / 1e6 AS t FROM counters),
       w AS (SELECT sensor, 1000000 + sensor * 5000 AS t_min, 1300000 + sensor * 5000 AS t_max FROM (SELECT DISTINCT sensor FROM r) q),
       x AS (SELECT r.*, t_min, t_max, lag(t) OVER o AS b, lead(t) OVER o AS a FROM r JOIN w USING (sensor) WINDOW o AS (PARTITION BY sensor ORDER BY t, rec))
       SELECT sensor, rec FROM x WHERE (t <= t_min AND (a IS NULL OR a > t_min)) OR (t > t_min AND t <= t_max)
         OR (t > t_max AND t <= t_max + 900 AND (b IS NULL OR b <= t_max))""",
    ("counters",),
)
def run_window(spark, sf):
    rows = table(spark, sf, "counters").select(
        (C("run") % 16).alias("sensor"), "rec", (C("us") / F.lit(1e6)).alias("t")
    )
    windows = rows.select("sensor").distinct().select(
        "sensor",
        (1000000 + C("sensor") * 5000).cast("double").alias("t_min"),
        (1300000 + C("sensor") * 5000).cast("double").alias("t_max"),
    )
    return machine.run_window(rows, windows, ["sensor"], ["t", "rec"], F.floor(C("t") / 3600)).select("sensor", "rec")


@query(
    "f14_per_bunch_values",
    f"""WITH {BUNCHES_SQL},
       v AS (SELECT a.fill, a.rec, max(b.rec) AS found FROM bn a LEFT JOIN bn b ON a.fill = b.fill AND b.beam = 1 AND b.t < a.t - 0.9 WHERE a.beam = 0 GROUP BY ALL),
       f AS (SELECT fill, arg_min(rec, t) AS first FROM bn WHERE beam = 1 GROUP BY fill),
       p AS (SELECT v.fill, v.rec, coalesce(found, first) AS conf FROM v JOIN f USING (fill))
       SELECT p.fill, p.rec, list_sum(list_transform(b.bunches, lambda k: CASE WHEN (k - 8910) // 10 < 30 THEN (p.rec % 100 + (k - 8910) // 10)::DOUBLE ELSE -1.0::DOUBLE END)) AS total
       FROM p JOIN bn b ON b.rec = p.conf""",
)
def per_bunch_values(spark, sf):
    rows = bunch_records(spark, sf)
    slots = F.sequence(F.lit(0), F.lit(29))
    values = rows.where("beam = 0").select(
        "fill", "rec", "t", F.transform(slots, lambda i: (C("rec") % 100 + i).cast("double")).alias("values")
    )
    conf = rows.where("beam = 1").select("fill", "rec", "t", F.transform("bunches", lambda b: b - 8910).alias("bunches"))
    found = machine.per_bunch(values, conf, ["fill"], 3600.0).where("per_bunch IS NOT NULL")
    total = F.aggregate("per_bunch", F.lit(0.0), lambda acc, v: acc + v)
    return found.select("fill", "rec", total.alias("total"))


_RANGES_SQL = "rg AS (SELECT sensor, min(t) + 3600 AS start, max(t) - 3600 AS end_ FROM readings GROUP BY sensor)"


def _ranges(spark, sf):
    return (
        table(spark, sf, "readings")
        .groupBy("sensor")
        .agg((F.min("t") + 3600).alias("start"), (F.max("t") - 3600).alias("end"))
    )


@query(
    "f15_sensor_value",
    f"""WITH {_RANGES_SQL},
       q AS (SELECT o_orderkey AS request, o_orderkey * 180.0::DOUBLE AS t, CASE o_orderkey % 2 WHEN 0 THEN 'error' ELSE 'view' END AS sensor FROM orders),
       c AS (SELECT request, q.sensor, greatest(least(t, end_), start) AS at_, t >= start AND t <= end_ AS inside FROM q JOIN rg USING (sensor))
       SELECT request, any_value(inside) AS inside, arg_max(r.reading, r.t) AS value FROM c LEFT JOIN readings r ON r.sensor = c.sensor AND r.t <= at_ GROUP BY request""",
    ("readings",),
)
def sensor_value(spark, sf):
    requests = base(spark, sf, "orders").select(
        C("o_orderkey").alias("request"),
        (C("o_orderkey") * F.lit(180.0)).alias("t"),
        F.when(C("o_orderkey") % 2 == 0, "error").otherwise("view").alias("sensor"),
    )
    readings = table(spark, sf, "readings").select("sensor", "t", "reading")
    found = series.sensor_value(requests, readings, _ranges(spark, sf), ["sensor"], 3600.0)
    return found.select("request", "inside", "value")


@query(
    "f16_resampled_sensor",
    f"""WITH {_RANGES_SQL},
       g AS (SELECT sensor, s AS step, start + s * ((end_ - start) / 500) AS t FROM rg, range(500) q(s))
       SELECT sensor, CAST(step AS INT) AS step, value FROM (SELECT g.sensor, g.step, arg_max(r.reading, r.t) AS value FROM g LEFT JOIN readings r ON r.sensor = g.sensor AND r.t <= g.t GROUP BY ALL) q""",
    ("readings",),
)
def resampled_sensor(spark, sf):
    readings = table(spark, sf, "readings").select("sensor", "t", "reading")
    found = series.resampled(readings, _ranges(spark, sf), ["sensor"], 500, 3600.0)
    return found.select("sensor", "step", "value")


# crossings one minute wide, so that several fall within the reach
_COARSE = "cx AS (SELECT run % 4 AS grp, rec, us // 60000000 AS crossing, rec % 2 AS kind FROM counters)"


def _coarse(spark, sf):
    return table(spark, sf, "counters").select(
        (C("run") % 4).alias("grp"), "rec", F.floor(C("us") / 60000000).alias("crossing"), (C("rec") % 2).alias("kind")
    )


@query(
    "f17_closest_interaction",
    f"""WITH {_COARSE},
       d AS (SELECT e.grp, e.rec, min(abs(i.crossing - e.crossing)) FILTER (i.crossing <> e.crossing) AS c0,
           min(abs(i.crossing - e.crossing)) FILTER (i.crossing < e.crossing OR i.crossing > e.crossing + 10) AS c10
         FROM cx e LEFT JOIN cx i ON e.grp = i.grp AND i.kind = 1 AND i.crossing BETWEEN e.crossing - 90 AND e.crossing + 90 WHERE e.kind = 0 GROUP BY ALL)
       SELECT grp, rec, coalesce(c0, 0) AS closest, coalesce(c10, 0) AS closest_with_gap FROM d""",
    ("counters",),
)
def closest_interaction(spark, sf):
    rows = _coarse(spark, sf)
    events, marks = rows.where("kind = 0").drop("kind"), rows.where("kind = 1")
    gaps = {"closest": 0, "closest_with_gap": 10}
    return series.closest_interactions(events, marks, ["grp"], "crossing", 1440, gaps).select("grp", "rec", *gaps)


@query(
    "f18_farthest_interaction",
    f"""WITH {_COARSE},
       d AS (SELECT e.grp, e.rec, max(abs(i.crossing - e.crossing)) AS f FROM cx e LEFT JOIN cx i ON e.grp = i.grp AND i.kind = 1
           AND i.crossing BETWEEN e.crossing - 90 AND e.crossing + 90 WHERE e.kind = 0 GROUP BY ALL)
       SELECT grp, rec, coalesce(f, 0) AS farthest FROM d""",
    ("counters",),
)
def farthest_interaction(spark, sf):
    rows = _coarse(spark, sf)
    found = series.farthest_interaction(
        rows.where("kind = 0").drop("kind"), rows.where("kind = 1"), ["grp"], "crossing", 1440
    )
    return found.select("grp", "rec", "farthest")


_HITS = "h AS (SELECT vec_id, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda v: v > 0.1)) AS hit FROM embeddings)"


def _hits(spark, sf):
    return base(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v > 0.1).alias("hits"))


@query(
    "f19_findable_rows",
    f"""WITH {_HITS},
       w AS (SELECT a.vec_id, a.i, a.hit, coalesce(bool_or(b.hit) FILTER (b.i < a.i AND b.i >= 5), false) OR a.i <= 0 AS before, coalesce(bool_or(b.hit) FILTER (b.i > a.i), false) AS after
         FROM h a JOIN h b ON a.vec_id = b.vec_id AND b.i BETWEEN a.i - 3 AND a.i + 3 WHERE a.i >= 5 AND a.i < 60 GROUP BY a.vec_id, a.i, a.hit),
       x AS (SELECT a.vec_id, a.i, a.hit, coalesce(bool_or(b.hit) FILTER (b.i <> a.i), false) OR a.i <= 0 AS near
         FROM h a JOIN h b ON a.vec_id = b.vec_id AND b.i BETWEEN a.i - 2 AND a.i + 2 GROUP BY a.vec_id, a.i, a.hit),
       s AS (SELECT vec_id, count(*) FILTER (hit) AS found, count(*) FILTER (hit OR before OR after) AS findable, count(*) FILTER (hit OR (before AND after)) AS findable_both FROM w GROUP BY vec_id)
       SELECT s.vec_id, CAST(found AS INT) AS found, CAST(findable AS INT) AS findable, CAST(findable_both AS INT) AS findable_both, r6(CASE WHEN findable > 0 THEN found / findable ELSE 0 END) AS fraction, CAST(crossed AS INT) AS crossed
       FROM s JOIN (SELECT vec_id, count(*) FILTER (hit OR near) AS crossed FROM x GROUP BY vec_id) c USING (vec_id)""",
)
def findable_rows(spark, sf):
    hits = C("hits")
    df = _hits(spark, sf).select(
        "vec_id",
        padrows.found_rows(hits, 5, 60).alias("found"),
        padrows.findable_rows(hits, 3, 5, 60).alias("findable"),
        padrows.findable_rows(hits, 3, 5, 60, both_sides=True).alias("findable_both"),
        padrows.crossed_rows(hits).alias("crossed"),
    )
    return df.withColumn("fraction", r6(padrows.row_fraction(C("found"), C("findable"))))


@query(
    "f20_cluster_density",
    f"""WITH {_HITS},
       w AS (SELECT a.vec_id, a.i, a.hit, coalesce(bool_or(b.hit) FILTER (b.i < a.i), false) AS down, coalesce(bool_or(b.hit) FILTER (b.i > a.i AND b.i < 60), false) AS up
         FROM h a JOIN h b ON a.vec_id = b.vec_id AND b.i BETWEEN a.i - 3 AND a.i + 3 WHERE a.i >= 5 AND a.i < 60 GROUP BY ALL),
       s AS (SELECT vec_id, count(*) FILTER (up AND down) AS findable, count(*) FILTER (up AND down AND hit) AS found, count(*) FILTER (hit) AS n_hits FROM w GROUP BY vec_id),
       g AS (SELECT vec_id, count(*) FILTER (v > -0.1) AS good, count(*) FILTER (v > 0.1) AS found2 FROM (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings) q WHERE i BETWEEN 10 AND 50 GROUP BY vec_id)
       SELECT vec_id, CAST(findable AS INT) AS findable, CAST(found AS INT) AS found, CAST(n_hits AS INT) AS n_hits, r6(CASE WHEN good > 20 THEN found2 / good ELSE 0.5 END) AS good_density FROM s JOIN g USING (vec_id)""",
)
def cluster_density(spark, sf):
    findable, found = padrows.density_rows(C("hits"), 3, 5, 60)
    index = F.transform("embedding", lambda v: F.when(v > 0.1, 7).when(v > -0.1, 0).otherwise(-1))
    df = base(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v > 0.1).alias("hits"), index.alias("index")
    )
    return df.select(
        "vec_id",
        findable.alias("findable"),
        found.alias("found"),
        padrows.found_rows(C("hits"), 5, 60).alias("n_hits"),
        r6(padrows.good_density(C("index"), 10, 50)).alias("good_density"),
    )


@query(
    "f21_gap_clusters",
    """WITH l AS (SELECT file_id, event_idx, obj_id, vz, v_zz, lag(vz) OVER w AS pz, lag(v_zz) OVER w AS pe FROM vertices WINDOW w AS (PARTITION BY event_idx ORDER BY vz, obj_id)),
       f AS (SELECT *, CASE WHEN pz IS NULL OR vz - pz > 3 OR (vz - pz) / greatest(sqrt(v_zz + pe), 0.000001) > 30 THEN 1 ELSE 0 END AS s FROM l)
       SELECT event_idx, obj_id, CAST(sum(s) OVER (PARTITION BY event_idx ORDER BY vz, obj_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM f""",
    ("vertices",),
)
def gap_clusters(spark, sf):
    points = table(spark, sf, "vertices").select("file_id", "event_idx", "obj_id", "vz", "v_zz")
    found = series.gap_clusters(points, ["file_id", "event_idx"], "vz", "v_zz", ["obj_id"], 8.0, gap=3.0, sigmas=30.0)
    return found.select("event_idx", "obj_id", "cluster")
