"""Results that must not depend on sizes or gaps of the input."""

import pytest
from pyspark.sql import functions as F

from eventloom.functions import triggers
from eventloom.operators import ancestry, robust, tables
from eventloom.operators.ordered import blocked, islands, numbered
from eventloom.plans.filters import with_names
from eventloom.sources import nested, texts

from .conftest import rows


def big_event(spark):
    headers = spark.createDataFrame([(0, 1), (0, 2)], "file_id long, event_idx long").withColumn("header", F.struct(F.lit(1).alias("run")))
    cells = spark.range(1000).select(
        F.lit(0).cast("long").alias("file_id"),
        F.when(F.col("id") < 990, 1).otherwise(2).cast("long").alias("event_idx"),
        F.col("id").alias("obj_id"),
        ((F.col("id") * 37) % 1000).alias("cell_number"),
    )
    return nested.nest(headers, {"cells": cells})


def test_positions_of_an_event_with_many_objects(spark):
    records = big_event(spark)
    assert records.count() > 2  # spread over fragments
    files = spark.createDataFrame([(0, 0)], "file_id long, file_pos long")
    found = nested.chained(records, files, F.lit(0))
    assert found.count() == records.count()
    assert rows(found.select("event_idx", "position").distinct()) == [(1, 0), (2, 1)]


def test_order_of_an_event_with_many_objects(spark):
    cells = big_event(spark).select("file_id", "event_idx", F.explode("cells").alias("c")).select("file_id", "event_idx", "c.*")
    placed = numbered(cells, tables.EVENT, F.floor(F.col("cell_number") / 100), ["cell_number", "obj_id"], "place")
    first = sorted((r.place, r.cell_number) for r in placed.where("event_idx = 1").collect())
    assert [p for p, _ in first] == list(range(1, 991)) and [n for _, n in first] == sorted(n for _, n in first)


HEAD = "2\n100 2 3 7\n"
RECORD = "5 0 10 20\n1 2 3 4 5 6\n1 2 3 4 5 6\n"


def counter_file(tmp_path, text):
    (tmp_path / "x.cnt").write_text(text)
    return str(tmp_path)


def test_counter_file_cut_off(spark, tmp_path):
    whole = texts.read_counters(spark, counter_file(tmp_path, HEAD + RECORD * 2))
    assert whole.count() == 4
    cut = texts.read_counters(spark, counter_file(tmp_path, HEAD + RECORD + "5 0 10 20\n1 2 3 4 5 6\n"))
    with pytest.raises(Exception, match="malformed last record"):
        cut.collect()
    with pytest.raises(Exception, match="malformed last record"):
        cut.count()


def test_counter_file_without_records(spark, tmp_path):
    assert texts.read_counters(spark, counter_file(tmp_path, HEAD)).collect() == []


def test_lost_mother_and_circle(spark):
    line = [(1, 0, -1), (1, 1, 0), (1, 2, 1), (1, 4, 3), (1, 5, 4)]  # 3 is missing
    df = spark.createDataFrame(line, "event_idx long, idx long, mother long")
    found = ancestry.first_ancestor(df, ["event_idx"], F.lit(False), "root")
    assert rows(found, "idx", "root") == [(0, 0), (1, 0), (2, 0), (4, None), (5, None)]
    circle = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 0)], "event_idx long, idx long, mother long")
    with pytest.raises(ValueError, match="circle"):
        ancestry.first_ancestor(circle, ["event_idx"], F.lit(False), "root")


def test_configuration_without_classes(spark):
    events = spark.createDataFrame([(1, 0, 3, 0), (2, 9, 3, 0)], "event_idx long, config long, mask long, mask_next long")
    classes = spark.createDataFrame([(0, 0, "A"), (0, 1, "B")], "config long, bit long, name string")
    df = with_names(events, triggers.name_lists(classes, ["config"], "bit"))
    fired = triggers.fired_classes(F.col("mask"), F.col("mask_next"), F.col("defined"))
    df = df.withColumn("fired", fired).withColumn("names", triggers.active_names(F.col("defined")))
    assert rows(df, "event_idx", "fired") == [(1, ["A", "B"]), (2, [])]
    passed = df.select("event_idx", triggers.expression("A && !B", "fired", "names").alias("p"))
    assert rows(passed) == [(1, False), (2, True)]


def test_null_key_is_a_key(spark):
    data = [(None, 1, 10), (None, 2, 20), (None, 30, 30), (1, 1, 5)]
    df = spark.createDataFrame(data, "k long, t long, x long")
    found = blocked(df, ["k"], F.floor(F.col("t") / 10), ["t"], running={"s": F.col("x")}, lag={"p": F.col("x")})
    assert rows(found, "k", "t", "s", "p") == [(1, 1, 5, None), (None, 1, 10, None), (None, 2, 30, 10), (None, 30, 60, 20)]
    runs = islands(df, ["k"], F.floor(F.col("t") / 10), ["t"], {"x": F.col("x")}, lambda: F.col("x") > F.col("_prev_x") + 9, ["x"])
    assert rows(runs, "t", "island") == [(1, 1), (1, 1), (2, 2), (30, 3)]


def test_positional_join_fails_whatever_is_used(spark):
    a = spark.createDataFrame([(0, 1, 1, 5), (0, 1, 2, 6)], "file_id long, event_idx long, obj_id long, a long")
    b = a.where("obj_id = 1").withColumnRenamed("a", "b")
    joined = tables.positional_join(a, b)
    for use in (joined.count, joined.select("a").collect, joined.collect):
        with pytest.raises(Exception, match="the tables differ"):
            use()
    assert tables.positional_join(a, a.withColumnRenamed("a", "b")).count() == 2


def test_robust_location_of_few_values(spark):
    df = spark.createDataFrame([(k, i, float(i)) for k in range(1, 5) for i in range(k)], "k long, i long, x double")
    h = F.floor(F.col("_n") * 0.6 - 1)
    found = robust.location_and_scale(df, ["k"], "x", h=h)
    assert [r[0] for r in rows(found, "k", "mean")] == [2, 3, 4]
    usual = robust.location_and_scale(df, ["k"], "x")
    assert rows(found, "k", "mean", "sigma") == rows(usual, "k", "mean", "sigma")


def test_cluster_without_shared_folder():
    from types import SimpleNamespace

    from eventloom.session import shared_folder

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder, set=lambda key, value: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("local-cluster[3,2,1000]"))
    assert shared_folder(session("yarn", "/shared")) == "/shared"
    assert shared_folder(session("local[4]"))


def test_queries_apply_their_settings(spark):
    import __spark_entry__ as entry

    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    entry.queries()["f11_instantaneous_luminosity"](spark, entry.FLAGSHIP_DIR)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_no_nested_loops_over_constants(spark):
    import __spark_entry__ as entry

    for name in ("e02_auto_range_histogram", "e15_event_plane", "n05_generator_of_particle"):
        df = entry.queries()[name](spark, entry.FLAGSHIP_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def arriving(spark, folder, batches, schema):
    """A stream of one file per batch, in their order."""
    import time

    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_rates_carry_over_batches(spark, tmp_path):
    from eventloom.streaming import flows

    top = 2**32
    batches = [[(1, 1, 0.0, top - 50), (1, 2, 10.0, 50), (2, 1, 0.0, 7)], [(1, 3, 20.0, 150)], [(1, 4, 7220.0, 100), (2, 2, 5.0, 17)]]
    stream = arriving(spark, str(tmp_path / "in"), batches, "run long, rec long, time double, count long")
    flows.batches_to_folder(flows.live_rates(stream, 3600), str(tmp_path / "out"), "update")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").where("rec IS NOT NULL").distinct().count() == 3
    got = flows.settled(got, ["run", "rec"], "revision")
    assert rows(got, "run", "rec", "total", "rate") == [
        (1, 1, top - 50, None), (1, 2, top + 50, 10.0), (1, 3, top + 150, 10.0), (1, 4, top + 100, -50 / 7200), (2, 1, 7, None), (2, 2, 17, 2.0),
    ]


def test_error_log_carries_over_batches(spark, tmp_path):
    from eventloom.streaming import flows

    batches = [[(0, 1, 5, 0, 1), (0, 2, 5, 0, 1), (1, 1, 5, 0, 1)], [(0, 3, 5, 0, 1)], [(0, 4, 5, 0, 1), (0, 5, 6, 0, 1), (1, 2, 9, 0, 2)]]
    stream = arriving(spark, str(tmp_path / "in"), batches, "file_id long, seq long, event_number long, ddl_id long, code int")
    flows.batches_to_folder(flows.live_error_log(stream, 3600), str(tmp_path / "out"), "update")
    got = flows.settled(spark.read.parquet(str(tmp_path / "out")), ["file_id", "island"], "revision")
    assert rows(got, "file_id", "island", "event_number", "code", "n") == [
        (0, 1, 5, 1, 4), (0, 2, 6, 1, 1), (1, 1, 5, 1, 1), (1, 2, 9, 2, 1),
    ]


def test_vertices_without_a_usable_covariance(spark):
    from eventloom.operators import cleaning

    names = "file_id long, event_idx long, obj_id long, x double, y double, z double, cov_xx double, cov_xy double, cov_yy double, cov_zz double, n_indices int, bunch int"
    far = [(0, 1, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 9, 0), (0, 1, 2, 0.0, 0.0, 50.0, 0.0, 0.0, 0.0, 0.0, 3, 0)]
    fine = [(0, 2, 1, 0.0, 0.0, 0.0, 1e-4, 0.0, 1e-4, 1e-4, 9, 0), (0, 2, 2, 0.0, 0.0, 50.0, 1e-4, 0.0, 1e-4, 1e-4, 3, 0)]
    found = cleaning.merge_split_vertices(spark.createDataFrame(far + fine, names), ["file_id", "event_idx"])
    assert rows(found, "event_idx", "obj_id", "discarded") == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, False)]


def test_window_positions_equal_all_pairs(spark):
    import random

    from eventloom.operators import lookups

    rng = random.Random(3)
    records = [(rng.choice([1, 1, 1, 2]), rng.randrange(60), i) for i in range(80)]
    events = [(rng.choice([1, 2, 3]), rng.randrange(-5, 70), 1000 + i) for i in range(40)]
    left = spark.createDataFrame(events, "k long, t long, e long")
    placed = lookups.positions(spark.createDataFrame(records, "k long, at long, i long"), ["k"], F.col("at"), ["i"], 7)
    found = lookups.window_positions(left, placed, ["k"], F.col("t") - 9, F.col("t"), 7)
    inside = {e: [i for q, at, i in records if q == k and t - 9 <= at <= t] for k, t, e in events}
    assert {r.e: r["last"] - r["first"] + 1 for r in found.collect()} == {e: len(v) for e, v in inside.items()}
    pairs = lookups.at_positions(found, placed, ["k"])
    assert rows(pairs, "e", "i") == sorted(((e, i) for e, v in inside.items() for i in v), key=repr)
    assert lookups.at_positions(found, placed.where("k > 9"), ["k"]).count() == 0


def test_tables_are_computed_once_when_written(spark, tmp_path):
    from eventloom.sources import sinks

    calls = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            calls.add(len(frame))
            yield frame

    some = spark.range(10).coalesce(1).mapInPandas(counted, "id long")
    assert sinks.write_tables({"some": some, "none": some.where("id < 0")}, str(tmp_path / "t")) == ["some"]
    assert calls.value == 20  # both tables, each read through once
    assert sinks.read_tables(spark, str(tmp_path / "t"), ["some"])["some"].count() == 10
