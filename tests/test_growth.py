"""Steps whose cost must not grow faster than their input."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.operators import cleaning, conditions, moments, regression, robust, series
from eventloom.plans import scalars, sources
from eventloom.sources import counterfiles, nested
from eventloom.streaming import flows
from tests.conftest import rows


def test_requests_beyond_the_range_are_not_looked_up_one_by_one(spark, monkeypatch):
    readings = spark.createDataFrame([("a", float(t), t * 10.0) for t in range(10)] + [("b", None, 1.0)], "sensor string, t double, reading double")
    ranges = readings.groupBy("sensor").agg((F.min("t") + 1).alias("start"), (F.max("t") - 1).alias("end"))
    times = [-5.0, 1.0, 2.5, 8.0, *[100.0 + i for i in range(50)], None]
    requests = spark.createDataFrame([(i, t, s) for i, t in enumerate(times) for s in ("a", "b", "c")], "request int, t double, sensor string")
    asked, latest = [], series.latest_reading
    monkeypatch.setattr(series, "latest_reading", lambda left, *more: asked.append(left) or latest(left, *more))
    got = series.sensor_value(requests, readings, ranges, ["sensor"], 2.0)
    assert rows(got.where("sensor = 'a'"), "request", "inside", "value") == sorted(
        [(0, False, 10.0), (1, True, 10.0), (2, True, 20.0), (3, True, 80.0), *[(i, False, 80.0) for i in range(4, 54)], (54, None, 80.0)], key=repr
    )
    assert got.where("sensor = 'b'").count() == 55 and got.where("sensor = 'c'").count() == 0
    assert sum(df.where("sensor = 'a'").count() for df in asked) == 3  # two ends and the one request between them


def test_cells_are_nested_alone(spark, tmp_path):
    """Readers of the cells' numbers read no other object's columns."""
    spark.range(40).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS double) AS o_totalprice",
        "CAST('1995-01-01' AS timestamp_ntz) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1000).selectExpr(
        "id % 30 AS l_orderkey", "id * 37 % 101 AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber",
        *[f"CAST(id % 50 AS double) AS l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")],
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = scalars.cells_by_number(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "l_linenumber" in plan and "l_tax" not in plan and "l_extendedprice" not in plan
    cells = {}
    for r in sources.table(spark, str(tmp_path), "cells").collect():
        cells.setdefault(r.event_idx, []).append((r.cell_number, r.obj_id))
    expected = [(e, *cell, i) for e, of in cells.items() for i, cell in enumerate(sorted(of), 1)]
    assert rows(got, "event_idx", "cell_number", "obj_id", "place") == sorted(expected, key=repr)


def test_small_counter_files_are_opened_once(tmp_path, monkeypatch):
    for run in range(3):
        (tmp_path / f"{run}.cnt").write_text(f"# counters\n2\n{run} 1 3\n" + "5 0 10 20\n1 2 3 4 5 6\n" * 4)
    opened, of = [], counterfiles.opened
    monkeypatch.setattr(counterfiles, "opened", lambda path: opened.append(path) or of(path))
    reader = counterfiles.CounterReader({"path": str(tmp_path)})
    shares = reader.partitions()
    opened.clear()
    found = pa.Table.from_batches([b for share in shares for b in reader.read(share)]).to_pydict()
    assert sorted(zip(found["run"], found["rec"], strict=True)) == [(run, rec) for run in range(3) for rec in range(4)]
    assert len(opened) == 3


class _State:
    """What the step of a stream sees of Spark's state."""

    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value

    def getCurrentWatermarkMs(self):
        return 0


def _step_of(monkeypatch, delay):
    """The step that the error log hands to Spark."""
    taken = []

    class Grouped:
        def groupBy(self, *_):
            return self

        def select(self, *_):
            return self

        def applyInPandasWithState(self, step, *_):
            taken.append(step)

    monkeypatch.setattr(flows, "_waiting", lambda *_: Grouped())
    flows.live_error_log(None, delay)
    return taken[0]


def test_error_log_holds_plain_numbers(spark, monkeypatch):
    """A file's messages of one batch take a few dozen bytes each, and come out in frames of bounded size."""
    import tracemalloc

    step, n, size = _step_of(monkeypatch, 0), 400_000, 10_000

    def frames():
        for a in range(0, n, size):
            seq = np.arange(a, a + size)[::-1]
            yield pd.DataFrame({"seq": seq, "event_number": seq // 200, "ddl_id": seq % 2, "code": pd.Series(seq % 3, dtype="Int64").mask(seq % 3 == 2)})

    state = _State()
    tracemalloc.start()
    shown, rows_out, last = 0, 0, None
    for frame in step((1,), frames(), state):
        assert len(frame) <= 100_000
        rows_out, shown, last = rows_out + len(frame), max(shown, len(frame)), frame
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows_out == n and last["island"].iloc[-1] == n and last["n"].iloc[-1] == 1
    assert peak < 150 * n
    *_, seq, event, ddl, code = state.get
    assert (seq, event, ddl, code) == ([n - 1], [(n - 1) // 200], [(n - 1) % 2], [None if (n - 1) % 3 == 2 else (n - 1) % 3])


@pytest.mark.parametrize("size", [2, 5, 40])
def test_stretches_are_decided_together(size, monkeypatch):
    rng = np.random.default_rng(size)
    geometry, bunches = [], []
    for _ in range(200):
        found = np.c_[rng.normal(0, 0.05, (size, 2)), rng.normal(0, 0.3, size), rng.uniform(0, 1e-2, (size, 4)), -np.sort(-rng.integers(1, 50, size))]
        found[:, 3:5] *= rng.random() > 0.1
        geometry.append(found)
        bunches.append(rng.choice([cleaning.UNKNOWN_BUNCH, 0, 1], size).tolist())
    one_by_one, alone = cleaning._claims, []
    monkeypatch.setattr(cleaning, "_claims", lambda *given: alone.append(1) or one_by_one(*given))
    lists = pa.array([g.tolist() for g in geometry], pa.list_(pa.list_(pa.float64())))
    got = cleaning._decided(lists, pa.array(bunches, pa.list_(pa.int32())), 10.0).to_pylist()
    assert [[(r["bunch"], r["discarded"]) for r in of] for of in got] == [one_by_one(g, list(b), 10.0) for g, b in zip(geometry, bunches, strict=True)]
    assert len(alone) == (200 if size > cleaning.TOGETHER else 0)


@pytest.mark.parametrize("degree", [0, 1, 2])
def test_dense_windows_are_smoothed_without_pairs(spark, monkeypatch, degree):
    """Points that the requests of a dense series are joined to, and each one's own least-squares polynomial."""
    rng = np.random.default_rng(degree)
    t = np.sort(np.concatenate([rng.uniform(0, 100, 4000).round(2), rng.uniform(115, 116, 300), [160.0]]))
    y = np.sin(t / 9) + rng.normal(0, 0.1, len(t))
    frame = pd.DataFrame({"k": 0, "t": t, "y": y, "id": range(len(t))})
    asks = [-1.0, 0.5, 12.0, 33.33, 77.7, 99.0, 103.9, 108.0, 117.0, 127.5, 160.0]
    requests = spark.createDataFrame([(k, x) for x in asks for k in (0, 1, None)], "k int, t double")
    paired, join = [], regression.range_join
    monkeypatch.setattr(regression, "range_join", lambda *a, **b: paired.append(join(*a, **b)) or paired[-1])
    found = regression.smoothed(requests, spark.createDataFrame(frame).withColumn("k", F.col("k").cast("int")), ["k"], 4.0, 3.0, degree, 25.0)
    got = {(r.k, r.t): r.smooth for r in found.collect()}
    assert paired[0].count() <= len(asks) * regression.SMOOTH_PAIRS
    place = lambda x: int((t <= x).sum()) - 1
    for x in asks:
        lo, middle, hi = place(x - 12), place(x), place(x + 12)
        if hi - lo < 4:
            lo, hi = middle - 2, middle + 2
        if lo < 0:
            lo, hi = 0, hi - lo
        if hi >= len(t):
            lo, hi = max(lo - (hi - len(t)), 0), len(t) - 1
        u = (t[lo : hi + 1] - x) / 4
        w = np.exp(-np.minimum(u * u, 100))  # of the root of the weight
        want = np.polynomial.Polynomial.fit(u, y[lo : hi + 1], min(degree, max(hi - lo - 2, 0)), w=w)(0.0)
        want = want if hi - lo >= 4 else 0.0
        assert got[0, x] == pytest.approx(want, rel=1e-6, abs=1e-7), (x, lo, hi)
        assert got[1, x] == got[None, x] == 0


def test_moments_give_the_sums_of_pairs():
    rng = np.random.default_rng(1)
    cells = moments.Cells(4.0, 3.0, 2)
    at, y = rng.uniform(0, 1, 50) * cells.step + 7 * cells.step, rng.normal(size=50)
    held = cells.of_points(at, np.full(50, 7.0), y, np.ones(50, bool)).sum(axis=0)
    for t in (7.3 * cells.step, 7 * cells.step - cells.reach, 8 * cells.step + cells.reach):
        centre = t - 1.0
        got = cells.at_requests(held[None, None], np.array([[7.0]]), np.array([t]), np.array([centre]))[0]
        w, v = np.exp(-2 * ((at - t) / 4.0) ** 2), (at - centre) / 4.0
        want = [(w * v ** (i + j)).sum() for i in range(3) for j in range(i, 3)] + [(w * v**i * y).sum() for i in range(3)]
        assert got == pytest.approx(want, rel=1e-11)


def test_pairs_of_one_path_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(conditions, "PAIRS", 20_000, raising=False)
    requests = spark.range(600).selectExpr("id AS request", "290000 + id * 7 % 64 AS run", "IF(id = 5, NULL, IF(id < 590, 'a', 'b')) AS path")
    entries = spark.range(500).selectExpr(
        "id AS entry", "IF(id = 6, NULL, IF(id < 490, 'a', 'c')) AS path",
        "IF(id % 97 = 0, -1, 290000 + id % 50) AS first_run", "IF(id % 97 = 0, -1, 290000 + id % 50 + id % 30) AS last_run",
    )
    found = conditions.valid_entries(requests, entries, ["path"])
    asked, held = requests.where("path IS NOT NULL").collect(), entries.where("path IS NOT NULL").collect()
    expected = [
        (q.request, e.entry) for q in asked for e in held
        if q.path == e.path and (e.first_run == -1 or e.first_run <= q.run <= e.last_run)
    ]
    assert rows(found, "request", "entry") == sorted(expected, key=repr)
    shares = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(shares) < len(expected) / 4


@pytest.mark.parametrize("shape", ["even", "heavy tail", "few values", "one value", "not finite"])
def test_only_rows_that_may_bound_the_best_window_are_ranked(spark, monkeypatch, shape):
    rng = np.random.default_rng(3)
    n = 30_000
    x = {
        "even": rng.normal(0, 1, n) + 100, "heavy tail": rng.standard_cauchy(n), "few values": rng.integers(0, 7, n) * 1.5,
        "one value": np.full(n, 2.5), "not finite": np.append(rng.normal(0, 1, n), [np.inf, np.nan]),
    }[shape]
    df = spark.createDataFrame(pd.DataFrame({"k": rng.integers(0, 2, len(x)), "x": x})).withColumn("k", F.nullif("k", F.lit(1)))
    df = df.unionByName(spark.createDataFrame([(5, 1.0), (6, 1.0), (6, 3.0), (6, None)], "k long, x double"))
    h = F.floor(F.col("_n") * 0.6 - 1)
    usual = robust.location_and_scale(df, ["k"], "x", h=h, median=True)
    writes, stored = [], robust.stored
    monkeypatch.setattr(robust, "stored", lambda df, name: writes.append((name, stored(df, name))) or writes[-1][1])
    found = robust.location_and_scale(df, ["k"], "x", h=h, median=True, few_keys=True)
    got, want = (sorted(map(tuple, d.collect()), key=repr) for d in (found, usual))
    assert [r[0] for r in got] == [r[0] for r in want]
    for a, b in zip(got, want):
        # of squares measured from a far lowest value, neither way keeps more digits
        assert a[1:] == pytest.approx(b[1:], rel=1e-6, abs=1e-9, nan_ok=True)
    ranked = dict(writes)["ranges"].count()
    assert ranked < n / 50 if shape == "even" else ranked <= df.count()


def test_exploded_requests_are_not_broadcast(spark, tmp_path):
    """The rows that pieces add are not in Spark's estimates, so small files would be broadcast whatever their requests."""
    spark.range(300).selectExpr("id AS request", "id % 40 AS run", "CAST(id % 3 AS string) AS l0").write.parquet(f"{tmp_path}/requests")
    spark.range(90).selectExpr(
        "id AS entry", "CAST(id % 3 AS string) AS l0", "IF(id % 30 = 7, -1, id % 40) AS first_run",
        "IF(id % 30 = 7, -1, id % 40 + id % 9) AS last_run", "id % 4 AS version", "id % 5 AS sub_version",
    ).write.parquet(f"{tmp_path}/entries")
    requests, entries = spark.read.parquet(f"{tmp_path}/requests"), spark.read.parquet(f"{tmp_path}/entries")
    rules = entries.selectExpr("entry AS rule_pos", "l0", "first_run", "last_run", "version AS rule_version")
    passes = entries.selectExpr("entry AS entry_idx", "l0", "first_run AS lower", "last_run AS upper", "IF(entry % 2 = 0, '', 'a') AS pass")
    defaults = entries.groupBy("l0").agg(F.min("entry").alias("default_idx"))
    best = conditions.best_version(requests, entries, ["l0"], ["request"]).select("request", "version", "sub_version", "entry", "n_top")
    exact = conditions.best_version(requests, entries, ["l0"], ["request"], version=F.col("request") % 4).select("request", "sub_version")
    ruled = conditions.apply_rules(requests, rules, ["l0"], ["request"]).select("request", "rule_version")
    layers = [("odd", entries.where("entry % 2 = 1")), ("all", entries)]
    layered = conditions.layered(requests, layers, ["l0"], ["request"]).select("request", "layer", "entry")
    asked = requests.withColumn("wanted_pass", F.lit("a"))
    found = conditions.object_for_run(asked, passes, defaults, ["l0"], ["request"]).select("request", "entry_idx")
    held = entries.collect()
    wants = [[] for _ in range(5)]
    for q in requests.collect():
        valid = [e for e in held if e.l0 == q.l0 and (e.first_run <= q.run <= e.last_run or e.first_run == -1)]
        numbers = [(e.version, e.sub_version) for e in valid]
        if valid:
            top = [e for e in valid if (e.version, e.sub_version) == max(numbers)]
            wants[0].append((q.request, *max(numbers), min(e.entry for e in top), len(top)))
        if subs := [s for v, s in numbers if v == q.request % 4]:
            wants[1].append((q.request, max(subs)))
        wants[2].append((q.request, min(valid, key=lambda e: e.entry).version if valid else None))
        odd = [e for e in valid if e.entry % 2]
        hit = max(odd or valid, key=lambda e: (e.version, e.sub_version, -e.entry), default=None)
        wants[3].append((q.request, ("odd" if odd else "all") if hit else None, hit and hit.entry))
        last = [e.entry for e in valid if e.first_run >= 0]
        wants[4].append((q.request, max(last, default=min(e.entry for e in held if e.l0 == q.l0))))
    for df, want in zip((best, exact, ruled, layered, found), wants, strict=True):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert rows(df) == sorted(want, key=repr)


def test_tables_of_the_same_rows_are_nested_with_one_shuffle(spark, capsys):
    keys = {"file_id": "k % 2", "event_idx": "k", "obj_id": "IF(v % 11 = 3, NULL, v % 60)"}
    base = spark.range(400).selectExpr("IF(id < 200, 1, IF(id % 50 = 9, NULL, id % 7)) AS k", "id AS v", "CAST(id AS string) AS file_id")
    tables = [nested.Projected(base, keys | fields) for fields in ({"a": "v * 2"}, {"b": "concat(file_id, 'v')"}, {"c": "v % 5"})]
    other = nested.Projected(base, keys | {"obj_id": "v", "d": "v"})
    headers = spark.createDataFrame([(k % 2, k) for k in (0, 1, 1, 2, 5, 8)] + [(None, 3)], "file_id long, event_idx long")
    headers = headers.withColumn("header", F.struct("event_idx"))
    objects = {"pairs": tables[:2], "single": tables[2]}
    found = nested.nest(headers, objects, size=10)
    capsys.readouterr()
    found.explain()
    lines = capsys.readouterr().out.splitlines()
    assert len([x for x in lines if "Exchange hashpartitioning" in x and "fragment" in x]) == 2  # the headers and the rows
    for kinds in (objects, objects | {"other": [other, tables[0]]}, {"single": [tables[2]]}):
        frames = {n: [t.table() for t in (ts if isinstance(ts, list) else [ts])] for n, ts in kinds.items()}
        assert rows(nested.nest(headers, kinds, size=10)) == rows(nested.nest(headers, frames, size=10))
    alone = nested.nest(headers, {}, size=10)
    assert rows(alone) == rows(found.where("fragment = 0").select(*alone.columns))


def test_records_hold_the_objects_that_their_reader_uses(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(40).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS double) AS o_totalprice",
        "CAST('1995-01-01' AS timestamp_ntz) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1000).selectExpr(
        "id % 30 AS l_orderkey", "id * 37 % 101 AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber",
        *[f"CAST(id % 50 AS double) AS l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")],
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    readers = {"COLLISION": set(), "CALO": {"cells"}, "MUON": {"muons"}, "TRACKEXTRA": {"tracks"}}
    found = {}
    for name, kinds in readers.items():
        path = sources.written_events(spark, folder, nested.kinds_of(name))
        assert set(spark.read.parquet(path).columns) == {"file_id", "event_idx", "fragment", "header"} | kinds
        found[name] = rows(nested.TABLES[name](sources.events_of(spark, folder, nested.kinds_of(name))))
    whole = sources.written_events(spark, folder)
    for name in readers:
        assert found[name] == rows(nested.TABLES[name](nested.read_events(spark, whole)))
    assert sources.written_events(spark, folder, ("cells", "muons")) == whole
    assert len(found["COLLISION"]) == 40 and len(found["CALO"]) == 1000
