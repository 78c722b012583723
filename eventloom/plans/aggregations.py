"""Histograms, profiles, robust statistics and per-event sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import status, tracks, triggers
from eventloom.operators import counters, eventwise, histograms, machine, robust, tables
from eventloom.operators.ordered import islands
from eventloom.plans.domain import base, table
from eventloom.plans.filters import CENTRALITY_SQL, centrality
from eventloom.plans.registry import query, r6

C = F.col


def _bins_sql(x: str, n: int, lo: float, hi: float, source: str, keys: str = "") -> str:
    """Dense histogram with a closed last bin."""
    k = f"{keys}, " if keys else ""
    inner = f"""SELECT {k}CAST(least(floor(({x} - {lo}) / ({hi}::DOUBLE - {lo}::DOUBLE) * {n}), {n - 1}) AS BIGINT) AS bin, count(*) AS content
      FROM {source} WHERE {x} >= {lo} AND {x} <= {hi} GROUP BY ALL"""
    if not keys:
        return f"SELECT b.bin, coalesce(content, 0) AS content FROM range({n}) b(bin) LEFT JOIN ({inner}) q ON q.bin = b.bin"
    on = " AND ".join(f"q.{c.strip()} = g.{c.strip()}" for c in keys.split(","))
    g = ", ".join(f"g.{c.strip()}" for c in keys.split(","))
    return f"""SELECT {g}, g.bin, coalesce(content, 0) AS content FROM
      (SELECT DISTINCT {keys}, b.bin FROM ({inner}) i, range({n}) b(bin)) g LEFT JOIN ({inner}) q ON {on} AND q.bin = g.bin"""


@query(
    "e01_histogram_momentum", _bins_sql("signed1pt", 100, -30, 30, "tracks"), ("tracks",)
)
def histogram_momentum(spark, sf):
    return histograms.histogram(table(spark, sf, "tracks"), C("signed1pt"), 100, -30.0, 30.0)


@query("e01_histogram_amplitude", _bins_sql("amplitude", 100, 0, 0.7, "cells"), ("cells",))
def histogram_amplitude(spark, sf):
    return histograms.histogram(table(spark, sf, "cells"), C("amplitude"), 100, 0.0, 0.7)


@query(
    "e02_auto_range_histogram",
    """WITH p AS (SELECT abs(1 / signed1pt) AS pt FROM tracks WHERE signed1pt <> 0),
       m AS (SELECT min(pt) AS lo, max(pt) AS hi FROM p),
       h AS (SELECT CAST(least(floor((pt - lo) / (hi - lo) * 100), 99) AS BIGINT) AS bin, count(*) AS content FROM p, m GROUP BY 1)
       SELECT r6(lo) AS lo, r6(hi) AS hi, b.bin, coalesce(content, 0) AS content FROM m, range(100) b(bin) LEFT JOIN h ON h.bin = b.bin""",
    ("tracks",),
)
def auto_range(spark, sf):
    found = histograms.auto_histogram(table(spark, sf, "tracks"), tracks.pt(C("signed1pt")))
    return found.select(r6(C("lo")).alias("lo"), r6(C("hi")).alias("hi"), "bin", "content")


STEPS_SQL = """steps AS (SELECT l_returnflag AS volume, CASE WHEN l_partkey % 7 = 0 THEN 1000010020 WHEN l_partkey % 7 = 1 THEN 1000080160
    ELSE l_partkey % 7 * 100 + 11 END AS pdg, l_quantity AS energy, l_tax AS dt, l_extendedprice / 10 - 5000 AS z, l_quantity * 25 AS x, l_discount * 100 AS y
  FROM lineitem)"""


def steps(spark, sf):
    """Transport steps: volume, particle, energy, time and place."""
    return base(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS volume",
        "CASE WHEN l_partkey % 7 = 0 THEN 1000010020 WHEN l_partkey % 7 = 1 THEN 1000080160"
        " ELSE l_partkey % 7 * 100 + 11 END AS pdg",
        "l_quantity AS energy",
        "l_tax AS dt",
        "l_extendedprice / 10 - 5000 AS z",
        "l_quantity * 25 AS x",
        "l_discount * 100 AS y",
        "l_linestatus AS part",
    )


@query(
    "e03_weighted_2d_histogram",
    f"""WITH {STEPS_SQL}, r AS (SELECT *, sqrt(x * x + y * y) AS r FROM steps)
       SELECT CASE WHEN z < -5000 THEN 0 WHEN z >= 5000 THEN 101 ELSE CAST(least(floor((z + 5000) / 10000 * 100) + 1, 100) AS BIGINT) END AS x_bin,
         CASE WHEN r < 0 THEN 0 WHEN r >= 1000 THEN 101 ELSE CAST(least(floor(r / 1000 * 100) + 1, 100) AS BIGINT) END AS y_bin,
         r6(sum(dt)) AS content FROM r GROUP BY ALL""",
)
def weighted_2d(spark, sf):
    df = steps(spark, sf).withColumn("r", F.sqrt(C("x") * C("x") + C("y") * C("y")))
    found = histograms.histogram_2d(df, (C("z"), 100, -5000.0, 5000.0), (C("r"), 100, 0.0, 1000.0), C("dt"))
    return found.withColumn("content", r6(C("content")))


PROFILE_SQL = """SELECT volume, CASE WHEN abs(pdg) > 10000 AND abs(pdg) NOT IN (1000010020, 1000010030, 1000020030, 1000020040, 50000050, 50000051)
    THEN 1111111111 ELSE pdg END AS pdg, r6(sum(dt)) AS time, r6(sum(energy * dt)) AS e_dt, count(*) AS n_steps FROM steps GROUP BY 1, 2"""


def _rounded_profile(df):
    return df.select("volume", "pdg", r6(C("time")).alias("time"), r6(C("e_dt")).alias("e_dt"), "n_steps")


@query("e04_time_profile", f"WITH {STEPS_SQL} {PROFILE_SQL}")
def time_profile(spark, sf):
    return _rounded_profile(histograms.time_profile(steps(spark, sf), ["volume"]))


@query("e05_merged_partials", f"WITH {STEPS_SQL} {PROFILE_SQL}")
def merged_partials(spark, sf):
    df = steps(spark, sf)
    parts = [histograms.time_profile(df.where(C("part") == p), ["volume"]) for p in ("O", "F")]
    return _rounded_profile(histograms.merged(parts, ["volume", "pdg"], ["time", "e_dt", "n_steps"]))


@query(
    "e06_value_frequency",
    "SELECT l_suppkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value",
)
def value_frequency(spark, sf):
    return histograms.frequencies(base(spark, sf, "lineitem"), C("l_suppkey"))


_RANGE = (200, 0.0, 200.0)
_SIGNAL_BINS = _bins_sql("tpc_signal", 200, 0, 200, "tracks_extra", "its_ncls")


def _signal_bins(spark, sf):
    return histograms.histogram(table(spark, sf, "tracks_extra"), C("tpc_signal"), *_RANGE, keys=["its_ncls"])


@query(
    "e07_truncated_mean",
    f"""WITH h AS ({_SIGNAL_BINS}),
       f AS (SELECT *, sum(content) OVER (PARTITION BY its_ncls ORDER BY bin) / sum(content) OVER (PARTITION BY its_ncls) AS fr, bin + 0.5 AS x FROM h),
       s AS (SELECT its_ncls, sum(content) AS w, sum(x * content) AS wx, sum(x * x * content) AS wxx FROM f
         WHERE bin < 199 AND fr > 0.05 AND fr < 0.7 GROUP BY its_ncls)
       SELECT its_ncls, r6(wx / w) AS mean, r6(sqrt(abs(wxx / w - (wx / w) * (wx / w)))) AS rms FROM s""",
    ("tracks_extra",),
)
def truncated_mean(spark, sf):
    found = histograms.truncated_mean(_signal_bins(spark, sf), ["its_ncls"], *_RANGE, down=0.05, up=0.7)
    return found.select("its_ncls", r6(C("mean")).alias("mean"), r6(C("rms")).alias("rms"))


_FACTORS = ", ".join(str(f) for f in robust.FACTORS)


def _robust_sql(variance: str) -> str:
    return f"""WITH v AS (SELECT its_ncls, tpc_signal AS x, obj_id, event_idx FROM tracks_extra),
      st AS (SELECT its_ncls, count(*) AS n, (count(*) + 2) // 2 AS h, min(x) AS lo FROM v GROUP BY its_ncls),
      rk AS (SELECT its_ncls, x, row_number() OVER w AS i, sum(x - lo) OVER w AS s1, sum((x - lo) * (x - lo)) OVER w AS s2, n, h, lo
        FROM v JOIN st USING (its_ncls) WINDOW w AS (PARTITION BY its_ncls ORDER BY x - lo, obj_id, event_idx ROWS UNBOUNDED PRECEDING)),
      wn AS (SELECT a.its_ncls, a.i, a.n, a.h, a.lo, b.s1 - a.s1 + (a.x - a.lo) AS t1, b.s2 - a.s2 + (a.x - a.lo) * (a.x - a.lo) AS t2
        FROM rk a JOIN rk b ON a.its_ncls = b.its_ncls AND b.i = a.i + a.h - 1 WHERE a.i <= a.n - a.h),
      q AS (SELECT *, t1 / h + lo AS m, {variance} AS var FROM wn),
      bs AS (SELECT *, row_number() OVER (PARTITION BY its_ncls ORDER BY var, i) AS r FROM q)
      SELECT its_ncls, r6(m) AS mean, r6(sqrt(abs(var)) * list_extract([{_FACTORS}],
        1 + greatest(least(CAST(trunc((h / n - 0.5) * 40) AS INT), 10), 0))::DOUBLE) AS sigma FROM bs WHERE r = 1"""


@query("e08_robust_location", _robust_sql("(t2 - h * (t1 / h) * (t1 / h)) / (h - 1)"), ("tracks_extra",))
def robust_location(spark, sf):
    found = robust.location_and_scale(table(spark, sf, "tracks_extra"), ["its_ncls"], "tpc_signal")
    return found.select("its_ncls", r6(C("mean")).alias("mean"), r6(C("sigma")).alias("sigma"))


@query(
    "e09_robust_location_external",
    _robust_sql("t2 / h + 2 * lo * (t1 / h) + lo * lo - (t1 / h + lo) * (t1 / h + lo) * 0.96"),
    ("tracks_extra",),
)
def robust_location_external(spark, sf):
    found = robust.location_and_scale(table(spark, sf, "tracks_extra"), ["its_ncls"], "tpc_signal", external=0.8)
    return found.select("its_ncls", r6(C("mean")).alias("mean"), r6(C("sigma")).alias("sigma"))


@query(
    "e10_least_trimmed_mean",
    f"""WITH h AS ({_SIGNAL_BINS}),
      v AS (SELECT its_ncls, bin, unnest(range(content)) AS k FROM h WHERE bin < 199),
      st AS (SELECT its_ncls, count(*) AS n, CAST(greatest(least(floor(count(*) * 0.6), count(*) - 1), floor(count(*) * 0.5)) AS BIGINT) AS h FROM v GROUP BY its_ncls),
      rk AS (SELECT its_ncls, bin + 0.5 AS x, n, h, row_number() OVER w AS i, sum(bin + 0.5) OVER w AS s1, sum((bin + 0.5) * (bin + 0.5)) OVER w AS s2
        FROM v JOIN st USING (its_ncls) WINDOW w AS (PARTITION BY its_ncls ORDER BY bin, k ROWS UNBOUNDED PRECEDING)),
      wn AS (SELECT a.its_ncls, a.i, a.n, a.h, b.s1 - a.s1 + a.x AS t1, b.s2 - a.s2 + a.x * a.x AS t2
        FROM rk a JOIN rk b ON a.its_ncls = b.its_ncls AND b.i = a.i + a.h - 1 WHERE a.i <= a.n - a.h),
      q AS (SELECT *, t1 / h::DOUBLE AS m, (t2 - h * (t1 / h::DOUBLE) * (t1 / h::DOUBLE)) / (h - 1)::DOUBLE AS var FROM wn),
      bs AS (SELECT *, row_number() OVER (PARTITION BY its_ncls ORDER BY var, i) AS r FROM q)
      SELECT its_ncls, r6(m) AS mean, r6(sqrt(abs(var)) * list_extract([{_FACTORS}],
        1 + greatest(least(CAST(trunc((h / n - 0.5) * 40) AS INT), 10), 0))::DOUBLE) AS sigma FROM bs WHERE r = 1""",
    ("tracks_extra",),
)
def least_trimmed_mean(spark, sf):
    found = robust.trimmed_histogram(_signal_bins(spark, sf), ["its_ncls"], *_RANGE, fraction=0.6)
    return found.select("its_ncls", r6(C("mean")).alias("mean"), r6(C("sigma")).alias("sigma"))


@query(
    "e11_centre_of_gravity",
    f"""WITH h AS ({_SIGNAL_BINS}),
       s AS (SELECT its_ncls, sum(content) AS w, sum((bin + 0.5) * content) AS wx, sum((bin + 0.5) * (bin + 0.5) * content) AS wxx,
         count(*) FILTER (content > 0) AS points FROM h GROUP BY its_ncls)
       SELECT its_ncls, r6(wx / w) AS cog, r6(CASE WHEN points = 1 THEN 1 / sqrt(12) ELSE sqrt(abs((wx / w) * (wx / w) - wxx / w)) END) AS rms,
         CAST(w AS BIGINT) AS sum FROM s""",
    ("tracks_extra",),
)
def centre_of_gravity(spark, sf):
    found = histograms.centre_of_gravity(_signal_bins(spark, sf), ["its_ncls"], *_RANGE)
    return found.select("its_ncls", r6(C("cog")).alias("cog"), r6(C("rms")).alias("rms"), "sum")


_DET = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))"
_M = ["s0", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4"]


def _column(i: int) -> str:
    m = list(_M)
    m[i], m[i + 3], m[i + 6] = "t0", "t1", "t2"
    return _DET.format(*m)


@query(
    "e12_gaussian_fit",
    f"""WITH h AS ({_SIGNAL_BINS}),
       p AS (SELECT its_ncls, bin + 0.5::DOUBLE - 100 AS x, content::DOUBLE AS w, ln(content) AS y FROM h WHERE content > 1),
       s AS (SELECT its_ncls, sum(w) AS s0, sum(w * x) AS s1, sum(w * x * x) AS s2, sum(w * x * x * x) AS s3, sum(w * x * x * x * x) AS s4,
         sum(w * y) AS t0, sum(w * y * x) AS t1, sum(w * y * x * x) AS t2 FROM p GROUP BY its_ncls HAVING count(*) > 3),
       c AS (SELECT its_ncls, {_column(0)} / {_DET.format(*_M)} AS a, {_column(1)} / {_DET.format(*_M)} AS b, {_column(2)} / {_DET.format(*_M)} AS c FROM s)
       SELECT its_ncls, CAST(1 AS DOUBLE) AS status, r6(any_value(exp(a + b * (b / (-2 * c)) + c * (b / (-2 * c)) * (b / (-2 * c))))) AS height,
         r6(any_value(b / (-2 * c) + 100)) AS mean, r6(any_value(1 / sqrt(abs(2 * c)))) AS sigma FROM h LEFT JOIN c USING (its_ncls) GROUP BY its_ncls""",
    ("tracks_extra",),
)
def gaussian_fit(spark, sf):
    found = histograms.gaussian_fit(_signal_bins(spark, sf), ["its_ncls"], *_RANGE)
    return found.select(
        "its_ncls", F.when(C("status") > 0, 1.0).otherwise(C("status")).alias("status"), *[r6(C(n)).alias(n) for n in ("height", "mean", "sigma")]
    )


def _moments_sql(weight: str) -> str:
    return ", ".join(
        [f"sum({weight} * pow(x, {k})) AS s{k}" for k in range(5)] + [f"sum({weight} * pow(x, {k}) * y) AS t{k}" for k in range(3)]
    )


def _parabola_sql(name: str, source: str) -> str:
    a, b, c = (f"{_column(i)} / {_DET.format(*_M)}" for i in range(3))
    return f"{name} AS (SELECT *, {a} AS a, {b} AS b, {c} AS c FROM {source})"


_SMOOTHED_SQL = f"""h AS ({_SIGNAL_BINS}),
  g AS (SELECT its_ncls, sum(content) AS total, max(content) AS top, sum(content * (bin - 99.5::DOUBLE)) / sum(content) AS m,
    sum(content * (bin - 99.5::DOUBLE) * (bin - 99.5::DOUBLE)) / sum(content) AS sq FROM h GROUP BY its_ncls HAVING sum(content) > 0),
  ex AS (SELECT *, total / sqrt(2 * pi() * sqrt(abs(sq - m * m))) AS expected FROM g),
  wd AS (SELECT *, CAST(round(6 / sqrt(expected)) AS INT) AS d FROM ex),
  ar AS (SELECT i.its_ncls, i.bin, any_value(i.content) AS own, count(j.bin) + 1 AS k, coalesce(sum(j.content), 0) AS near
    FROM h i JOIN wd USING (its_ncls) LEFT JOIN h j ON j.its_ncls = i.its_ncls AND j.bin BETWEEN greatest(i.bin - d, 1) AND least(i.bin + d, 197) GROUP BY ALL),
  pt AS (SELECT its_ncls, bin - 99.5::DOUBLE AS x, k::DOUBLE AS k, ln((own + near) / k::DOUBLE) AS y FROM ar WHERE (own + near) / k::DOUBLE > 1),
  m1 AS (SELECT its_ncls, count(*) AS points, {_moments_sql("k")} FROM pt GROUP BY its_ncls), {_parabola_sql("f1", "m1")},
  pr AS (SELECT pt.*, exp(a + b * x + c * x * x) AS guess, points AS points0 FROM pt JOIN f1 USING (its_ncls)),
  m2 AS (SELECT its_ncls, any_value(points0) AS points0, count(*) AS points, {_moments_sql("guess * k")}, sum(guess * k * y * y) AS tt
    FROM pr WHERE guess > 1 GROUP BY its_ncls), {_parabola_sql("f2", "m2")},
  ok AS (SELECT *, top >= 4 AND total >= 12 AND expected >= 1 AND points0 > 3 AND points > 3 AND abs(b - 200 * c) >= 2.220446049250313e-16 AND abs(c) >= 2.220446049250313e-16 AS good
    FROM f2 JOIN wd USING (its_ncls))"""


@query(
    "e12_gaussian_fit_smoothed",
    f"""WITH {_SMOOTHED_SQL}
       SELECT its_ncls, CASE WHEN good THEN r6((tt - a * t0 - b * t1 - c * t2) / points) ELSE -1 END AS status,
         CASE WHEN good THEN r6(exp(a + b * (b / (-2 * c)) + c * (b / (-2 * c)) * (b / (-2 * c)))) END AS height,
         CASE WHEN good THEN r6(b / (-2 * c) + 100) END AS mean, CASE WHEN good THEN r6(1 / sqrt(abs(2 * c))) END AS sigma FROM ok""",
    ("tracks_extra",),
)
def gaussian_fit_smoothed(spark, sf):
    found = histograms.gaussian_fit_smoothed(_signal_bins(spark, sf), ["its_ncls"], *_RANGE)
    return found.select("its_ncls", *[r6(C(n)).alias(n) for n in ("status", "height", "mean", "sigma")])


# --- 64-channel arrays --------------------------------------------------------------

_AMP = "list_transform(embedding, lambda v: abs(v)::DOUBLE)"


def amplitudes(spark, sf):
    values = F.transform("embedding", lambda v: F.abs(v).cast("double"))
    return base(spark, sf, "embeddings").select("vec_id", "label", values.alias("amp"))


def _list_sum(a: int, b: int) -> str:
    return f"r6(list_sum(list_slice(amp, {a + 1}, {b})))"


@query(
    "e13_ring_sums",
    f"""WITH a AS (SELECT vec_id, list_transform(embedding, lambda v: CASE WHEN v > 0 THEN v::DOUBLE ELSE 0 END) AS amp FROM embeddings)
       SELECT vec_id, {_list_sum(32, 64)} AS total_a, {_list_sum(0, 32)} AS total_c,
         CAST(len(list_filter(list_slice(amp, 33, 64), lambda v: v > 0)) AS INT) AS fired_a,
         CAST(len(list_filter(list_slice(amp, 1, 32), lambda v: v > 0)) AS INT) AS fired_c,
         {', '.join(f'{_list_sum(32 + 8 * r, 40 + 8 * r)} AS ring_a{r}, {_list_sum(8 * r, 8 + 8 * r)} AS ring_c{r}' for r in range(4))}
       FROM a""",
)
def ring_sums(spark, sf):
    values = F.transform("embedding", lambda v: F.when(v > 0, v.cast("double")).otherwise(0.0))
    df = base(spark, sf, "embeddings").select("vec_id", values.alias("amp"))
    sums = eventwise.ring_sums(C("amp"))
    return df.select("vec_id", *[(c if n.startswith("fired") else r6(c)).alias(n) for n, c in sums.items()])


CHANNELS = 64

# one factor per channel and run; the run is the label
_FACTOR_SQL = f"""a AS (SELECT vec_id, label, {_AMP} AS amp FROM embeddings),
  u AS (SELECT vec_id, label, unnest(range(64)) AS ch, unnest(amp) AS m FROM a),
  f AS (SELECT label, ch, avg(m) AS f FROM u GROUP BY label, ch),
  e AS (SELECT vec_id, u.label, u.ch, m / (f.f * 8 / sum(f.f) OVER (PARTITION BY vec_id, u.ch // 8)) AS eq FROM u JOIN f ON u.label = f.label AND u.ch = f.ch)"""


def equalised(spark, sf):
    """Amplitudes with the equalised channel multiplicities of their run."""
    amps = amplitudes(spark, sf)
    means = [F.avg(F.get("amp", F.lit(i))) for i in range(CHANNELS)]
    factors = amps.groupBy("label").agg(F.array(*means).alias("factors"))
    return amps.join(factors, "label").withColumn("eq", eventwise.equalised(C("amp"), C("factors")))


@query("e14_equalised_multiplicity", f"WITH {_FACTOR_SQL} SELECT vec_id, CAST(ch AS INT) AS channel, r6(eq) AS eq FROM e")
def equalised_multiplicity(spark, sf):
    df = equalised(spark, sf).select("vec_id", F.posexplode("eq").alias("channel", "eq"))
    return df.withColumn("eq", r6(C("eq")))


_CORRECTIONS = {
    "mean_x": "n_nationkey / 1e3",
    "mean_y": "n_nationkey / 2e3",
    "a_plus": "1 + n_nationkey / 5e1",
    "a_minus": "1 + n_nationkey / 4e1",
    "lambda_plus": "n_nationkey / 1e2",
    "lambda_minus": "n_nationkey / 9e1",
    "cos8": "n_nationkey / 3e1",
}
_CORR_SQL = f"""cr AS (SELECT n_nationkey AS ring, {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in _CORRECTIONS.items())}
  FROM nation WHERE n_nationkey < 11)"""
_FLAT_SQL = """c1 AS (SELECT *, qx - mean_x AS px, qy - mean_y AS py, 1 - lambda_plus * lambda_minus AS dt FROM q),
  c2 AS (SELECT *, (px / dt - lambda_minus / dt * py) / a_plus AS u, (py / dt - lambda_plus / dt * px) / a_minus AS v FROM c1),
  c3 AS (SELECT *, cos8 * sin(8 * (atan2(v, u) / 2)) AS tw FROM c2),
  fl AS (SELECT *, u * cos(tw) - v * sin(tw) AS fx, u * sin(tw) + v * cos(tw) AS fy FROM c3)"""


def _corrections(spark, sf):
    """One row: the correction constants of the rings as an array in ring order."""
    fields = [F.expr(e).cast("double").alias(n) for n, e in _CORRECTIONS.items()]
    rows = base(spark, sf, "nation").where("n_nationkey < 11").select(
        F.lit(1).alias("one"), C("n_nationkey").alias("ring"), F.struct(*fields).alias("c")
    )
    return tables.columns_to_lists(rows, ["one"], "ring", "c", "corrections")


@query(
    "e15_event_plane",
    f"""WITH {_FACTOR_SQL}, {_CORR_SQL},
       rg AS (SELECT ch, ch // 8 AS ring FROM range(64) r(ch) UNION ALL SELECT ch, CASE WHEN ch >= 32 THEN 8 ELSE 9 END FROM range(64) r(ch)
         UNION ALL SELECT ch, 10 FROM range(64) r(ch)),
       q0 AS (SELECT vec_id, rg.ring, sum(eq) AS mult, sum(eq * cos(2 * (pi() / 8 + pi() / 4 * (e.ch % 8)))) AS qx,
           sum(eq * sin(2 * (pi() / 8 + pi() / 4 * (e.ch % 8)))) AS qy,
           sum(eq * cos(3 * (pi() / 8 + pi() / 4 * (e.ch % 8)))) AS q3x, sum(eq * sin(3 * (pi() / 8 + pi() / 4 * (e.ch % 8)))) AS q3y
         FROM e JOIN rg ON e.ch = rg.ch GROUP BY vec_id, rg.ring),
       q AS (SELECT * FROM q0 JOIN cr USING (ring)), {_FLAT_SQL}
       SELECT vec_id, r6(max(CASE WHEN ring = 8 THEN atan2(fy, fx) / 2 END)) AS side_a,
         r6(max(CASE WHEN ring = 9 THEN atan2(fy, fx) / 2 END)) AS side_c,
         r6(max(CASE WHEN ring = 10 THEN atan2(fy, fx) / 2 END)) AS all_rings,
         r6(max(CASE WHEN ring = 10 THEN atan2(q3y, q3x) / 3 END)) AS third,
         r6(atan2(sum(fy) FILTER (ring < 4), sum(fx) FILTER (ring < 4)) / 2) AS ring_range
       FROM fl GROUP BY vec_id""",
)
def event_plane(spark, sf):
    df = equalised(spark, sf).withColumn("corrections", _corrections(spark, sf).select("corrections").scalar())

    def corr(ring: int):
        return F.get("corrections", F.lit(ring))

    return df.select(
        "vec_id",
        r6(eventwise.event_plane(C("eq"), 8, 2, corr(8))).alias("side_a"),
        r6(eventwise.event_plane(C("eq"), 9, 2, corr(9))).alias("side_c"),
        r6(eventwise.event_plane(C("eq"), 10, 2, corr(10))).alias("all_rings"),
        r6(eventwise.event_plane(C("eq"), 10, 3)).alias("third"),
        r6(eventwise.event_plane_of_rings(C("eq"), range(4), 2, C("corrections"))).alias("ring_range"),
    )


@query(
    "e16_multiplicity_estimators",
    """WITH a AS (SELECT event_idx, 1 AS t, CAST((used_by & 281470681808895) = 0 AS INT) AS i, CAST((used_by & -281470681808896) = 0 AS INT) AS p
         FROM tracklets WHERE abs(-ln(tan(theta / 2))) <= 0.5
       UNION ALL SELECT event_idx, 0, CAST((flags & 268435456) = 0 AS INT), CAST((flags & 268435456) <> 0 AS INT)
         FROM tracks JOIN tracks_extra USING (file_id, event_idx, obj_id)
         WHERE abs(-ln(tan((pi() / 2 - atan(tgl)) / 2))) <= 0.5 AND (flags & 1) <> 0 AND (flags & 67108864) = 0 AND (flags & 33554432) = 0)
       SELECT event_idx, CAST(sum(t) AS BIGINT) AS tracklets, CAST(sum(i) AS BIGINT) AS its_tpc, CAST(sum(p) AS BIGINT) AS pure FROM a GROUP BY event_idx""",
    ("tracklets", "tracks", "tracks_extra"),
)
def multiplicity_estimators(spark, sf):
    main = table(spark, sf, "tracks").select(*tables.OBJECT, "tgl")
    flagged = main.join(table(spark, sf, "tracks_extra").select(*tables.OBJECT, "flags"), tables.OBJECT)
    found = eventwise.multiplicities(table(spark, sf, "tracklets"), flagged, tables.EVENT, 0.5, True, True)
    return found.drop("file_id")


@query(
    "e17_refitted_tracks",
    "SELECT event_idx, count(*) FILTER ((flags & 64) <> 0) AS n_refit FROM tracks_extra GROUP BY event_idx",
    ("tracks_extra",),
)
def refitted_tracks(spark, sf):
    df = table(spark, sf, "tracks_extra")
    return df.groupBy("event_idx").agg(F.count_if(triggers.any_bit(C("flags"), status.TPC_REFIT)).alias("n_refit"))


@query(
    "e18_layer_clusters",
    """SELECT vec_id, CAST(list_sum(list_slice(list_transform(embedding, lambda v: CAST(floor(abs(v) * 100) AS BIGINT)), 2, 5)) AS BIGINT) AS n_clusters
       FROM embeddings""",
)
def layer_clusters(spark, sf):
    counts = F.transform("embedding", lambda v: F.floor(F.abs(v) * 100))
    return base(spark, sf, "embeddings").select("vec_id", eventwise.layer_clusters(counts, 1, 4).alias("n_clusters"))


@query(
    "e19_run_length_error_log",
    """WITH l AS (SELECT *, lag(event_number) OVER w AS pe, lag(ddl_id) OVER w AS pd, lag(code) OVER w AS pc FROM error_log
         WINDOW w AS (PARTITION BY file_id ORDER BY seq)),
       i AS (SELECT *, sum(CASE WHEN pe = event_number AND pd = ddl_id AND pc = code THEN 0 ELSE 1 END) OVER (PARTITION BY file_id ORDER BY seq) AS island FROM l)
       SELECT file_id, CAST(island AS BIGINT) AS island, any_value(event_number) AS event_number, any_value(ddl_id) AS ddl_id, any_value(code) AS code, count(*) AS n
       FROM i GROUP BY file_id, island""",
    ("error_log",),
)
def run_length_error_log(spark, sf):
    names = ("event_number", "ddl_id", "code")

    def starts():
        changed = F.lit(False)
        for n in names:
            changed = changed | (C(n) != C(f"_prev_{n}"))
        return changed

    runs = islands(
        table(spark, sf, "error_log"),
        ["file_id"],
        F.floor(C("seq") / 65536),
        ["seq"],
        {n: C(n) for n in names},
        starts,
        uses=names,
    )
    return runs.groupBy("file_id", "island").agg(*[F.first(n).alias(n) for n in names], F.count("*").alias("n"))


@query(
    "e20_events_per_run",
    """SELECT run, sum(n)::BIGINT AS n_events, count(*) AS n_files, max(CASE WHEN file_id = 3 THEN n END) AS n_file_three
       FROM (SELECT run, file_id, count(*) AS n FROM collisions GROUP BY run, file_id) f GROUP BY run""",
    ("collisions",),
)
def events_per_run(spark, sf):
    files = table(spark, sf, "collisions").groupBy("run", "file_id").agg(F.count("*").alias("n"))
    return files.groupBy("run").agg(
        F.sum("n").alias("n_events"),
        F.count("*").alias("n_files"),
        F.max(F.when(C("file_id") == 3, C("n"))).alias("n_file_three"),
    )


@query(
    "e21_detectors_in_mask",
    "SELECT event_idx, CAST(bit_count(pattern) AS INT) AS n_detectors FROM collisions",
    ("collisions",),
)
def detectors_in_mask(spark, sf):
    return table(spark, sf, "collisions").select("event_idx", F.bit_count("pattern").alias("n_detectors"))



@query(
    "e22_mean_intensity",
    """WITH cf AS (SELECT label, min(vec_id) AS conf FROM embeddings GROUP BY label),
       u AS (SELECT label, vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
       b AS (SELECT u.label, vec_id, v, (i + conf) % 3 = 0 AS inter, ((1 + i * 50) // 10 + 344) % 3564 AS slot FROM u JOIN cf ON u.label = cf.label)
       SELECT label, r6(coalesce(sum(v) FILTER (inter AND v >= 0 AND slot % 4 <> 0), 0) / count(DISTINCT vec_id)) AS colliding,
         r6(coalesce(sum(v) FILTER (NOT inter AND v >= 0 AND slot % 7 <> 0), 0) / count(DISTINCT vec_id)) AS noncolliding,
         count(DISTINCT vec_id) AS n_records FROM b GROUP BY label""",
)
def mean_intensity(spark, sf):
    records = base(spark, sf, "embeddings").select("label", C("embedding").cast("array<double>").alias("values"))
    conf = base(spark, sf, "embeddings").groupBy("label").agg(F.min("vec_id").alias("conf"))
    numbers = F.sequence(F.lit(0), F.lit(63))
    sign = lambda i: F.when((i + C("conf")) % 3 == 0, -1).otherwise(1)
    bunches = conf.select("label", F.transform(numbers, lambda i: sign(i) * (1 + i * 50)).alias("bunches"))
    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(machine.SLOTS - 1).cast("bigint"))
    masks = conf.select(
        "label",
        F.filter(slots, lambda s: s % 4 == 0).alias("masked_both"),
        F.filter(slots, lambda s: s % 7 == 0).alias("masked_single"),
    )
    found = machine.mean_intensity(records, bunches, masks, ["label"], beam=0)
    return found.select("label", r6(C("colliding")).alias("colliding"), r6(C("noncolliding")).alias("noncolliding"), "n_records")


@query(
    "e23_interacting_bunch_count",
    """SELECT vec_id, CAST(len(list_filter(embedding, lambda v: v < 0)) AS INT) AS n_interacting,
         contains(lower(CASE WHEN label % 2 = 0 THEN 'Single_12b_wP_4inj' ELSE 'Multi_48b' END), 'wp') AS pilot FROM embeddings""",
)
def interacting_bunch_count(spark, sf):
    scheme = F.when(C("label") % 2 == 0, "Single_12b_wP_4inj").otherwise("Multi_48b")
    return base(spark, sf, "embeddings").select(
        "vec_id",
        F.size(F.filter("embedding", lambda v: v < 0)).alias("n_interacting"),
        machine.pilot_present(scheme).alias("pilot"),
    )


@query(
    "e24_active_detectors",
    """WITH u AS (SELECT p_brand, p_partkey, unnest(string_split(p_name, ' ')) AS name, unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part),
       f AS (SELECT p_brand, name, min(p_partkey * 100 + pos) AS first FROM u GROUP BY ALL)
       SELECT p_brand AS config, string_agg(name, ' ' ORDER BY first) AS names FROM f GROUP BY p_brand""",
)
def active_detectors(spark, sf):
    df = base(spark, sf, "part").select(C("p_brand").alias("config"), "p_partkey", "p_name")
    return eventwise.first_seen(df, ["config"], "p_partkey", F.split("p_name", " "))


@query(
    "e25_whole_run_delta",
    """SELECT run, arg_max(c5, rec) - arg_min(c5, rec) AS delta, arg_max(us, rec) - arg_min(us, rec) AS elapsed FROM counters GROUP BY run""",
    ("counters",),
)
def whole_run_delta(spark, sf):
    found = counters.whole_run_delta(table(spark, sf, "counters"), ["run"], ["us", "rec"], ["c5", "us"])
    return found.select("run", C("d_c5").alias("delta"), C("d_us").alias("elapsed"))


@query(
    "e26_centrality_percentile",
    f"""WITH {CENTRALITY_SQL}
       SELECT event_idx, method, CASE WHEN quality = 0 THEN percentile ELSE -1 END AS percentile,
         CASE WHEN quality = 0 THEN CAST(trunc(percentile / 10) AS INT) ELSE -1 END AS class10,
         CASE WHEN quality = 0 THEN CAST(trunc(percentile / 5) AS INT) ELSE -1 END AS class5,
         CAST(trunc(percentile / 10) AS INT) AS class10_unchecked FROM cent""",
    ("collisions",),
)
def centrality_percentile(spark, sf):
    value, quality = C("percentile"), C("quality")
    return centrality(spark, sf).select(
        "event_idx",
        "method",
        eventwise.percentile(value, quality).alias("percentile"),
        eventwise.percentile_class(value, quality, 10).alias("class10"),
        eventwise.percentile_class(value, quality, 5).alias("class5"),
        eventwise.percentile_class(value, F.lit(0), 10).alias("class10_unchecked"),
    )


@query(
    "e26_percentile_with_fallback",
    """SELECT event_idx, CASE WHEN run - 90032 < 200000 THEN chi2 * 2 ELSE n_contrib * 1.5::DOUBLE END AS percentile FROM collisions""",
    ("collisions",),
)
def percentile_with_fallback(spark, sf):
    value = eventwise.with_fallback(C("run") - 90032, C("chi2") * 2, C("n_contrib") * F.lit(1.5))
    return table(spark, sf, "collisions").select("event_idx", value.alias("percentile"))


@query(
    "e27_trigger_mask_occupancy",
    """WITH w AS (SELECT c_custkey // 72 AS mask_id, c_custkey % 72 AS crate, (c_custkey * 40503) % 16777216 AS word FROM customer),
       g AS (SELECT mask_id, crate, p.pad, (word >> p.pad) & 1 = 1 AS on_ FROM w, range(23) p(pad))
       SELECT mask_id, crate, CAST(pad AS INT) AS pad, on_ AS "on", CAST(sum(on_::INT) OVER (PARTITION BY mask_id) AS BIGINT) AS n_on FROM g""",
)
def trigger_mask_occupancy(spark, sf):
    words = base(spark, sf, "customer").select(
        F.floor(C("c_custkey") / 72).alias("mask_id"),
        (C("c_custkey") % 72).alias("crate"),
        ((C("c_custkey") * 40503) % 16777216).alias("word"),
    )
    counts = words.groupBy("mask_id").agg(F.sum(eventwise.words_on(C("word")).cast("bigint")).alias("n_on"))
    return eventwise.word_grid(words, ["mask_id", "crate"], "word").join(counts, "mask_id")
