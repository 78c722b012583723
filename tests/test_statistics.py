"""Histograms, robust statistics, fits and tests against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom import session
from eventloom.operators import histograms, quality, regression, robust, splines
from tests.conftest import rows

C = F.col


def scan(values, h, factor):
    """Sliding window over the sorted values, without the topmost window."""
    x, n = sorted(values), len(values)
    best = min(((np.var(x[i : i + h], ddof=1), i) for i in range(n - h)))
    return np.mean(x[best[1] : best[1] + h]), factor * math.sqrt(best[0])


def factor(h, n):
    return robust.FACTORS[max(0, min(int((h / n - 0.5) * 40), 10))]


def test_robust_location(spark):
    rng = random.Random(1)
    values = [rng.gauss(5, 1) for _ in range(300)] + [rng.uniform(-50, 50) for _ in range(80)]
    df = spark.createDataFrame([(0, v, i) for i, v in enumerate(values)], "k int, x double, id int")
    got = robust.location_and_scale(df, ["k"], "x").first()
    h = (len(values) + 2) // 2
    mean, sigma = scan(values, h, factor(h, len(values)))
    assert got.mean == pytest.approx(mean) and got.sigma == pytest.approx(sigma)


@pytest.mark.parametrize("external", [None, 0.8])
def test_robust_location_with_heavy_values(spark, external):
    """A key with most of the rows, a value with a tenth of it, and keys of few kinds of values."""
    rng = random.Random(6)
    data = {
        0: [7.0] * 90 + [rng.gauss(5, 3) for _ in range(700)],
        1: [float(rng.randrange(5)) for _ in range(200)],
        2: [1.0] * 50 + [rng.uniform(0, 1) for _ in range(20)],
        3: [float(i) for i in range(40)],
        None: [2.0] * 30 + [3.0] * 3,
    }
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [(0, None)], "k int, x double").repartition(5)
    for h in (None, 2, 17):
        found = robust.location_and_scale(df, ["k"], "x", h=None if h is None else F.lit(h), external=external, median=True).collect()
        assert len(found) == len(data)
        for row in found:
            x = np.sort(data[row.k])
            size = h or (len(x) + 2) // 2
            best = None
            for i in range(len(x) - size):
                part = x[i : i + size]
                f = 0.96
                v = part.var(ddof=1) if external is None else (part**2).mean() - part.mean() ** 2 * f
                if best is None or v < best[0] - 1e-9:
                    best = (v, part.mean())
            assert row.sigma == pytest.approx(factor(size, len(x)) * math.sqrt(abs(best[0])), abs=1e-5)
            if external is not None or best[0] > 1e-9:
                assert row.mean == pytest.approx(best[1], rel=1e-6)
            assert row.median == pytest.approx(np.median(x))


def test_values_are_dealt_evenly(spark, monkeypatch):
    """No range holds over twice the median, with a value of a tenth of all rows and a key with most of them."""
    given = spark.range(60000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 10 == 0, 1.5).otherwise(F.exp(F.randn(3))).alias("x"),
    )
    ranges = []
    monkeypatch.setattr(robust, "stored", lambda df, name: ranges.append(session.stored(df, name)) or ranges[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, ranked = robust.ranked_values(given, ["k"], "x")
        sizes = sorted(r["count"] for r in ranges[0].groupBy("_range").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    last = ranked.groupBy("k").agg(F.max("_rank"), F.countDistinct("_rank"), F.first("_n")).collect()
    assert len(last) == 50 and all(r[1] == r[2] == r[3] for r in last)


def test_robust_location_of_few_values(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (0, 3.0, 1), (1, 4.0, 2)], "k int, x double, id int")
    got = robust.location_and_scale(df, ["k"], "x").collect()
    assert [(r.k, r.mean) for r in got] == [(0, 2.0)]


@pytest.mark.parametrize("seed", range(4))
def test_trimmed_histogram_equals_the_written_out_one(spark, seed):
    rng = random.Random(seed)
    content = [rng.choice([0, 0, 1, 2, 5, 40]) for _ in range(30)]
    bins = spark.createDataFrame([(0, i, c) for i, c in enumerate(content)], "k int, bin bigint, content bigint")
    values = [(i + 0.5) / 3 for i, c in enumerate(content[:-1]) for _ in range(c)]
    n = len(values)
    h = max(min(int(0.6 * n), n - 1), int(0.5 * n))
    mean, sigma = scan(values, h, factor(h, n))
    got = robust.trimmed_histogram(bins, ["k"], 30, 0.0, 10.0, 0.6).first()
    assert got.sigma == pytest.approx(sigma, abs=1e-6) and got.mean == pytest.approx(mean)


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 0.5, 1.0, 1.1)], "x double")
    got = histograms.histogram(df, C("x"), 4, 0.0, 1.0)
    assert rows(got, "bin", "content") == [(0, 1), (1, 0), (2, 1), (3, 1)]


def test_overflow_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0)], "x double")
    got = df.select("x", histograms.bin_with_overflow(C("x"), 2, 0.0, 1.0).alias("b"))
    assert rows(got) == [(-1.0, 0), (0.0, 1), (1.0, 3)]


def gaussian_bins(spark, keys=3, n=60):
    rng = np.random.default_rng(3)
    data = []
    for k in range(keys):
        counts, _ = np.histogram(rng.normal(4 + k, 0.8, 5000), n, (0, 12))
        data += [(k, i, int(c)) for i, c in enumerate(counts)]
    return spark.createDataFrame(data, "k int, bin bigint, content bigint")


@pytest.mark.parametrize("fit", [histograms.gaussian_fit, histograms.gaussian_fit_smoothed])
def test_gaussian_fit_finds_mean_and_sigma(spark, fit):
    for r in fit(gaussian_bins(spark), ["k"], 60, 0.0, 12.0).collect():
        assert r.status > 0 and r.mean == pytest.approx(4 + r.k, abs=0.1) and r.sigma == pytest.approx(0.8, abs=0.1)


@pytest.mark.parametrize(
    "content, status",
    [([0, 3, 0, 0], -4), ([0, 20, 0, 0], -1), ([0, 20, 10, 0], -2), ([5, 20, 10, 0], -3), ([0, 0, 0, 0], -4)],
)
def test_gaussian_fit_of_few_bins(spark, content, status):
    bins = spark.createDataFrame([(0, i, c) for i, c in enumerate(content)], "k int, bin bigint, content bigint")
    assert histograms.gaussian_fit(bins, ["k"], 4, 0.0, 4.0).first().status == status


def test_chi2_probability(spark):
    known = [(3.841, 1, 0.05), (5.991, 2, 0.05), (18.307, 10, 0.05), (2.0, 30, 1.0), (200.0, 10, 0.0)]
    df = spark.createDataFrame([(x, n) for x, n, _ in known], "x double, n int")
    got = [r.p for r in df.select(quality.chi2_probability(C("x"), C("n")).alias("p")).collect()]
    assert got == pytest.approx([p for *_, p in known], abs=1e-3)


def test_kolmogorov_probability(spark):
    df = spark.createDataFrame([(0.1,), (1.36,), (3.0,)], "z double")
    got = [r.p for r in df.select(quality.kolmogorov_probability(C("z")).alias("p")).collect()]
    assert got == pytest.approx([1.0, 0.0495, 0.0], abs=1e-3)


def test_severity_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.002,), (0.5,), (1.0,), (None,)], "s double")
    got = [r.v for r in df.select(quality.severity(C("s")).alias("v")).collect()]
    assert got == ["FATAL", None, "ERROR", "WARNING", "INFO", "FATAL"]


def test_status_word_sets_and_clears_only_its_task(spark):
    log = [(0, 1, 0, 2), (1, 1, 1, 3), (2, 1, 0, 0), (3, 1, 1, None), (4, 1, 2, 1)]
    df = spark.createDataFrame(log, "seq int, det int, task int, bit int")
    assert quality.status_words(df, ["det"]).first().status == 0b0010_0000_0001


def test_local_fit_recovers_a_quadratic(spark):
    rng = random.Random(2)
    data = [(x, y, 3 + 2 * x - x * x + 0.5 * y + 0.25 * y * y, 1.0) for x, y in
            ((rng.uniform(0, 4), rng.uniform(0, 2)) for _ in range(600))]
    df = spark.createDataFrame(data, "x double, y double, v double, e double")
    grid = [("x", 4, 0.0, 4.0), ("y", 2, 0.0, 2.0)]
    fits = regression.local_fit(df, grid, [F.lit(0.6), F.lit(0.6)], "v", "e", 0.01)
    assert fits.count() == 8
    for r in regression.evaluated(df, fits, grid).collect():
        assert r.fit == pytest.approx(r.v, abs=1e-6) and r.slope_0 == pytest.approx(2 - 2 * r.x, abs=1e-5)


def test_local_fit_cut_removes_an_outlier(spark):
    data = [(i / 100, 2.0 + 0.001 * (i % 7), 1.0, i) for i in range(100)] + [(0.5, 500.0, 1.0, 1000)]
    df = spark.createDataFrame(data, "x double, v double, e double, id int")
    grid = [("x", 1, 0.0, 1.0)]
    stats = regression.local_statistics(df, grid, [F.lit(1.0)], "v", 0.01)
    fits = regression.local_fit(df, grid, [F.lit(1.0)], "v", "e", 0.01, statistics=stats, cut=5.0)
    assert fits.first().coefficients[0] == pytest.approx(2.0, abs=0.02)


def test_spline_follows_a_noisy_wave(spark):
    rng = np.random.default_rng(4)
    data = [(k, float(t), float(math.sin(t / 80) + rng.normal(0, 0.05)), t) for k in (0, 1) for t in range(1500)]
    df = spark.createDataFrame(data, "k int, t double, y double, id int")
    knots = splines.fitted(df, ["k"], 40, 200.0)
    curve = splines.evaluated(df.withColumnRenamed("y", "noisy"), knots, ["k"], "t", 200.0, derivatives=(0, 1))
    off = [(r.y - math.sin(r.t / 80), r.y1 - math.cos(r.t / 80) / 80) for r in curve.where("t between 60 and 1440").collect()]
    mean, rms = np.mean([o[0] for o in off]), np.std([o[0] for o in off])
    assert abs(mean) < 0.01 and rms < 0.05 and np.std([o[1] for o in off]) < 0.01


def test_spare_knots_go(spark):
    straight = [(0, float(x), 2.0 * x, 2.0, 1e-4) for x in range(9)]
    df = spark.createDataFrame(straight, "k int, x0 double, value double, slope double, value_var double")
    assert splines.without_spare_knots(df, ["k"], 3.0, 2).count() < 6


def test_smoothing_needs_five_points(spark):
    few = spark.createDataFrame([(0, float(t), 1.0, t) for t in range(4)], "k int, t double, y double, id int")
    many = spark.createDataFrame([(0, float(t), 1.0 + 2 * t, t) for t in range(40)], "k int, t double, y double, id int")
    ask = spark.createDataFrame([(0, 2.5)], "k int, t double")
    assert regression.smoothed(ask, few, ["k"], 1.0, 3.0, 2, 10.0).first().smooth == 0
    assert regression.smoothed(ask, many, ["k"], 2.0, 3.0, 1, 10.0).first().smooth == pytest.approx(6.0)


@pytest.mark.parametrize("degree", [0, 1, 2])
def test_smoothing_equals_weighted_polynomials(spark, degree):
    """Every request's own least-squares polynomial, with a request that one near point would dominate."""
    rng = random.Random(degree)
    t = sorted(rng.uniform(0, 100) for _ in range(150)) + [130.0, 131.0, 132.0, 133.0, 134.0, 135.0]
    points = [(0, x, math.sin(x / 9) + rng.gauss(0, 0.1), i) for i, x in enumerate(t)]
    series = spark.createDataFrame(points, "k int, t double, y double, id int")
    asks = [-1.0, 0.5, 33.3, 77.7, 99.0, 117.0, 129.99, 133.2, 140.0]
    requests = spark.createDataFrame([(0, x) for x in asks], "k int, t double")
    found = {r.t: r.smooth for r in regression.smoothed(requests, series, ["k"], 4.0, 3.0, degree, 25.0).collect()}
    place = lambda x: sum(v <= x for v in t) - 1
    for x in asks:
        lo, middle, hi = place(x - 12), place(x), place(x + 12)
        if hi - lo < 4:
            lo, hi = middle - 2, middle + 2
        if lo < 0:
            lo, hi = 0, hi - lo
        if hi >= len(t):
            lo, hi = max(lo - (hi - len(t)), 0), len(t) - 1
        near = np.array(points)[lo : hi + 1]
        u = (near[:, 1] - x) / 4
        w = np.exp(-np.minimum(u * u, 100))  # of the root of the weight
        fitted = np.polynomial.Polynomial.fit(u, near[:, 2], min(degree, max(hi - lo - 2, 0)), w=w)
        want = fitted(0.0) if len(near) > 4 else 0.0
        assert found[x] == pytest.approx(want, rel=1e-5, abs=1e-6), (x, lo, hi)
