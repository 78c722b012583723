"""Local regression, splines and kernel smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import regression, robust, splines
from eventloom.plans.domain import table
from eventloom.plans.registry import query, r6

C = F.col
_FACTORS = ", ".join(str(f) for f in robust.FACTORS)

# energy loss over inner momentum, 12 bins, kernel a third of a bin wide at the least
GRID = [("inner_p", 12, 0.2, 5.6)]
GRID_2D = [("inner_p", 12, 0.2, 5.6), ("tpc_ncls", 10, 0.0, 160.0)]
WEIGHT_CUT = 0.01
POINTS_SQL = """pt AS (SELECT event_idx, obj_id, inner_p AS x, tpc_signal AS y, 1 + its_ncls / 10.0::DOUBLE AS e, 0.15 + tpc_ncls / 2000.0::DOUBLE AS k
    FROM tracks_extra WHERE inner_p IS NOT NULL),
  nb AS (SELECT pt.*, b.bin, x - (0.2 + (b.bin + 0.5) * 0.45) AS d FROM pt, range(12) b(bin) WHERE pow((x - (0.2 + (b.bin + 0.5) * 0.45)) / k, 2) <= -2 * ln(0.01))"""


def points(spark, sf):
    return (
        table(spark, sf, "tracks_extra")
        .where("inner_p IS NOT NULL")
        .select(
            "event_idx",
            "obj_id",
            "inner_p",
            "tpc_ncls",
            "tpc_signal",
            (1 + C("its_ncls") / F.lit(10.0)).alias("error"),
            (0.15 + C("tpc_ncls") / F.lit(2000.0)).alias("kernel"),
        )
    )


_DET = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))"
_M = ["s0", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4"]


def _column(i: int) -> str:
    m = list(_M)
    m[i], m[i + 3], m[i + 6] = "t0", "t1", "t2"
    return _DET.format(*m)


FITS_SQL = f"""{POINTS_SQL},
  w AS (SELECT bin, d, y, exp(-pow(d / k, 2)) / (e * e) AS w FROM nb),
  sm AS (SELECT bin, count(*) AS n, sum(w) AS s0, sum(w * d) AS s1, sum(w * d * d) AS s2, sum(w * d * d * d) AS s3, sum(w * d * d * d * d) AS s4,
    sum(w * y) AS t0, sum(w * y * d) AS t1, sum(w * y * d * d) AS t2 FROM w GROUP BY bin HAVING count(*) > 4),
  ft AS (SELECT bin, n, {_column(0)} / {_DET.format(*_M)} AS a, {_column(1)} / {_DET.format(*_M)} AS b, {_column(2)} / {_DET.format(*_M)} AS c,
    (s2 * s4 - s3 * s3) / {_DET.format(*_M)} AS va FROM sm)"""


def _fits(spark, sf):
    return regression.local_fit(points(spark, sf), GRID, [C("kernel")], "tpc_signal", "error", WEIGHT_CUT)


@query(
    "m01_local_fit",
    f"WITH {FITS_SQL} SELECT CAST(bin AS INT) AS bin, n AS n_points, r6(a) AS constant, r6(b) AS slope, r6(c) AS square FROM ft",
    ("tracks_extra",),
)
def local_fit(spark, sf):
    at = lambda i: r6(F.element_at("coefficients", i))
    return _fits(spark, sf).select(
        C("bin_0").alias("bin"), "n_points", at(1).alias("constant"), at(2).alias("slope"), at(3).alias("square")
    )


def _eliminated(size: int) -> str:
    """Tables e1, e2, ... that eliminate one unknown after the other from e0 (m<row><column>, right side last)."""
    steps = []
    for k in range(size - 1):
        rows = ", ".join(
            f"m{i}{j} - m{i}{k} * m{k}{j} / m{k}{k} AS m{i}{j}" for i in range(k + 1, size) for j in range(k + 1, size + 1)
        )
        steps.append(f"e{k + 1} AS (SELECT bin_0, bin_1, n, {rows} FROM e{k})")
    return ", ".join(steps)


# slopes and squares of both axes first, the constant last: it is what elimination leaves
_BASIS = ("d0", "d0 * d0", "d1", "d1 * d1", "1")
_NORMAL = ", ".join(
    f"sum(w * ({a}) * ({b})) AS m{i}{j}" for i, a in enumerate(_BASIS) for j, b in enumerate((*_BASIS, "y"))
)
TWO_AXES_SQL = f"""pt AS (SELECT inner_p AS x0, tpc_ncls AS x1, tpc_signal AS y, 1 + its_ncls / 10.0::DOUBLE AS e, 0.15 + tpc_ncls / 2000.0::DOUBLE AS k
    FROM tracks_extra WHERE inner_p IS NOT NULL),
  nb AS (SELECT b0.b AS bin_0, b1.b AS bin_1, y, e, (x0 - (0.2 + (b0.b + 0.5) * 0.45)) AS r0, (x1 - (b1.b + 0.5) * 16) AS r1, k
    FROM pt, range(12) b0(b), range(10) b1(b)
    WHERE pow((x0 - (0.2 + (b0.b + 0.5) * 0.45)) / k, 2) + pow((x1 - (b1.b + 0.5) * 16) / (100 * k), 2) <= -2 * ln({WEIGHT_CUT})),
  ww AS (SELECT bin_0, bin_1, y, r0 / 0.45 AS d0, r1 / 16 AS d1, exp(-(pow(r0 / k, 2) + pow(r1 / (100 * k), 2))) / (e * e) AS w FROM nb),
  e0 AS (SELECT bin_0, bin_1, count(*) AS n, {_NORMAL} FROM ww GROUP BY bin_0, bin_1 HAVING count(*) > 6), {_eliminated(5)}"""


@query(
    "m01_local_fit_two_axes",
    f"WITH {TWO_AXES_SQL} SELECT CAST(bin_0 AS INT) AS bin_0, CAST(bin_1 AS INT) AS bin_1, n AS n_points, r6(m45 / m44) AS constant FROM e4",
    ("tracks_extra",),
)
def local_fit_two_axes(spark, sf):
    df = points(spark, sf)
    kernels = [C("kernel"), C("kernel") * 100]
    fits = regression.local_fit(df, GRID_2D, kernels, "tpc_signal", "error", WEIGHT_CUT, bin_units=True)
    return fits.select("bin_0", "bin_1", "n_points", r6(F.element_at("coefficients", 1)).alias("constant"))


STATISTICS_SQL = f"""{POINTS_SQL},
  st AS (SELECT bin, count(*) AS n, CAST(floor(count(*) * 0.6 - 1) AS BIGINT) AS h, min(y) AS lo, median(y) AS median FROM nb GROUP BY bin),
  rk AS (SELECT bin, y, row_number() OVER w AS i, sum(y - lo) OVER w AS s1, sum((y - lo) * (y - lo)) OVER w AS s2, n, h, lo, median
    FROM nb JOIN st USING (bin) WINDOW w AS (PARTITION BY bin ORDER BY y, obj_id, event_idx ROWS UNBOUNDED PRECEDING)),
  wn AS (SELECT a.bin, a.i, a.n, a.h, a.lo, a.median, b.s1 - a.s1 + (a.y - a.lo) AS t1, b.s2 - a.s2 + (a.y - a.lo) * (a.y - a.lo) AS t2
    FROM rk a JOIN rk b ON a.bin = b.bin AND b.i = a.i + a.h - 1 WHERE a.i <= a.n - a.h),
  q AS (SELECT *, t1 / h + lo AS m, (t2 - h * (t1 / h) * (t1 / h)) / (h - 1) AS var FROM wn),
  bs AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY var, i) AS r FROM q),
  rs AS (SELECT bin, median, m AS mean, sqrt(abs(var)) * list_extract([{_FACTORS}], 1 + greatest(least(CAST(trunc((h / n - 0.5) * 40) AS INT), 10), 0))::DOUBLE AS sigma FROM bs WHERE r = 1)"""


def _statistics(spark, sf):
    return regression.local_statistics(points(spark, sf), GRID, [C("kernel")], "tpc_signal", WEIGHT_CUT)


@query(
    "m02_local_statistics",
    f"WITH {STATISTICS_SQL} SELECT CAST(bin AS INT) AS bin, r6(median) AS median, r6(mean) AS mean, r6(sigma) AS sigma FROM rs",
    ("tracks_extra",),
)
def local_statistics(spark, sf):
    return _statistics(spark, sf).select(C("bin_0").alias("bin"), *[r6(C(c)).alias(c) for c in ("median", "mean", "sigma")])


_KEPT_FITS = FITS_SQL.removeprefix(POINTS_SQL).replace("FROM nb", "FROM nx")


@query(
    "m02_local_fit_without_outliers",
    f"""WITH {STATISTICS_SQL}, nx AS (SELECT nb.* FROM nb JOIN rs USING (bin) WHERE abs(y - median) <= 1.5 * sigma){_KEPT_FITS}
       SELECT CAST(bin AS INT) AS bin, n AS n_points, r6(a) AS constant FROM ft""",
    ("tracks_extra",),
)
def local_fit_without_outliers(spark, sf):
    fits = regression.local_fit(
        points(spark, sf), GRID, [C("kernel")], "tpc_signal", "error", WEIGHT_CUT,
        statistics=_statistics(spark, sf), cut=1.5,
    )
    return fits.select(C("bin_0").alias("bin"), "n_points", r6(F.element_at("coefficients", 1)).alias("constant"))


@query(
    "m03_evaluate_fit",
    f"""WITH {FITS_SQL},
       ev AS (SELECT event_idx, obj_id, greatest(least(inner_p, 5.6), 0.2) AS x FROM tracks_extra WHERE inner_p IS NOT NULL),
       lc AS (SELECT *, least(floor((x - 0.2) / 0.45), 11) AS bin FROM ev),
       dl AS (SELECT *, x - (0.2 + (bin + 0.5) * 0.45) AS d FROM lc)
       SELECT event_idx, obj_id, r6(coalesce(a + b * d + c * d * d, 0)) AS fit, r6(coalesce(sqrt(va), 0)) AS fit_error, r6(coalesce(b + 2 * c * d, 0)) AS slope
       FROM dl LEFT JOIN ft ON ft.bin = dl.bin""",
    ("tracks_extra",),
)
def evaluate_fit(spark, sf):
    at = points(spark, sf).select("event_idx", "obj_id", "inner_p")
    found = regression.evaluated(at, _fits(spark, sf), GRID)
    return found.select(
        "event_idx", "obj_id", r6(C("fit")).alias("fit"), r6(C("fit_error")).alias("fit_error"), r6(C("slope_0")).alias("slope")
    )


def _series(spark, sf):
    """Readings with a slow wave under the noise."""
    wave = F.sin(C("t") / 200000.0) * 50
    return table(spark, sf, "readings").select("sensor", "t", (C("reading") + wave).alias("y"), C("rec").alias("id"))


@query("m04_spline_fit")
def spline_fit(spark, sf):
    knots = splines.fitted(_series(spark, sf), ["sensor"], per_knot=40, block_width=86400.0)
    return knots.select("sensor", r6(C("x0")).alias("x0"), *[C(f"c{i}") for i in range(4)])


@query("i06_spline_evaluation")
def spline_evaluation(spark, sf):
    """The fitted curve and its slope at every reading."""
    series = _series(spark, sf)
    knots = splines.fitted(series, ["sensor"], per_knot=40, block_width=86400.0)
    found = splines.evaluated(series, knots, ["sensor"], "t", 86400.0, derivatives=(0, 1, 2, 3))
    return found.select("sensor", "id", *[C(c) for c in ("y", "y1", "y2", "y3")])


@query(
    "i06_piecewise_cubic",
    """WITH k AS (SELECT sensor, rec, t AS x0, reading AS c0 FROM readings WHERE rec % 50 = 0),
       m AS (SELECT r.sensor, r.rec, r.t, max(k.rec) AS krec FROM readings r LEFT JOIN k ON k.sensor = r.sensor AND k.x0 <= r.t GROUP BY ALL),
       f AS (SELECT sensor, arg_min(rec, x0) AS frec FROM k GROUP BY sensor),
       j AS (SELECT m.sensor, m.rec, (m.t - k.x0) / 3600 AS d, k.c0 FROM m JOIN f USING (sensor) JOIN k ON k.sensor = m.sensor AND k.rec = coalesce(krec, frec))
       SELECT sensor, rec, r6(c0 + d * (0.5 + d * (0.01 * c0 + d * 1e-4))) AS y, r6(0.5 + d * (0.02 * c0 + d * 3e-4)) AS y1,
         r6(0.02 * c0 + 6e-4 * d) AS y2, r6(6e-4) AS y3 FROM j""",
    ("readings",),
)
def piecewise_cubic(spark, sf):
    rows = table(spark, sf, "readings").select("sensor", "rec", (C("t") / 3600).alias("x"), "reading")
    knots = rows.where("rec % 50 = 0").select(
        "sensor", C("x").alias("x0"), C("reading").alias("c0"), F.lit(0.5).alias("c1"),
        (C("reading") * 0.01).alias("c2"), F.lit(1e-4).alias("c3"),
    )
    found = splines.evaluated(rows, knots, ["sensor"], "x", 24.0, derivatives=(0, 1, 2, 3))
    return found.select("sensor", "rec", *[r6(C(c)).alias(c) for c in ("y", "y1", "y2", "y3")])


@query(
    "m05_kernel_smoothing",
    """WITH s AS (SELECT sensor, t, reading AS y, rec, row_number() OVER (PARTITION BY sensor ORDER BY t, rec) - 1 AS i, count(*) OVER (PARTITION BY sensor) AS n FROM readings),
       q AS (SELECT sensor, t + 30 AS t, rec FROM readings WHERE rec % 4 = 0),
       a AS (SELECT q.sensor, q.t, q.rec, any_value(n) AS n, coalesce(max(i) FILTER (s.t <= q.t - 6000), -1) AS i0, coalesce(max(i) FILTER (s.t <= q.t + 6000), -1) AS i1,
         coalesce(max(i) FILTER (s.t <= q.t), -1) AS im FROM q JOIN s ON s.sensor = q.sensor GROUP BY q.sensor, q.t, q.rec),
       b AS (SELECT *, CASE WHEN i1 - i0 < 4 THEN im - 2 ELSE i0 END AS lo, CASE WHEN i1 - i0 < 4 THEN im + 2 ELSE i1 END AS hi FROM a),
       c AS (SELECT sensor, t, rec, n, greatest(lo, 0) AS lo, CASE WHEN lo < 0 THEN hi - lo ELSE hi END AS hi FROM b),
       d AS (SELECT sensor, t, rec, greatest(CASE WHEN hi >= n THEN lo - (hi - n) ELSE lo END, 0) AS lo, CASE WHEN hi >= n THEN n - 1 ELSE hi END AS hi FROM c),
       w AS (SELECT d.sensor, d.rec, least(1, greatest(hi - lo - 2, 0)) AS deg, (s.t - d.t) / 2000 AS u, y, exp(-2 * least(pow((s.t - d.t) / 2000, 2), 100)) AS w
         FROM d JOIN s ON s.sensor = d.sensor AND s.i BETWEEN lo AND hi),
       v AS (SELECT *, sum(w * u) OVER k / sum(w) OVER k AS um, sum(w * y) OVER k / sum(w) OVER k AS ym FROM w WINDOW k AS (PARTITION BY sensor, rec)),
       m AS (SELECT sensor, rec, any_value(deg) AS deg, count(*) AS n, any_value(um) AS um, any_value(ym) AS ym,
         sum(w * (u - um) * (y - ym)) / sum(w * (u - um) * (u - um)) AS slope FROM v GROUP BY sensor, rec)
       SELECT sensor, rec, r6(CASE WHEN n <= 4 THEN 0 WHEN deg = 1 THEN ym - slope * um ELSE ym END) AS smooth FROM m""",
    ("readings",),
)
def kernel_smoothing(spark, sf):
    rows = table(spark, sf, "readings")
    series = rows.select("sensor", "t", C("reading").alias("y"), C("rec").alias("id"))
    requests = rows.where("rec % 4 = 0").select("sensor", (C("t") + 30).alias("t"), "rec")
    found = regression.smoothed(requests, series, ["sensor"], 2000.0, 3.0, 1, 21600.0)
    return found.select("sensor", "rec", r6(C("smooth")).alias("smooth"))
