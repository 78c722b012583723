"""Streams with state: out of order, late, over restarts, the same rows as in batch."""

import random
import time

from eventloom.streaming import flows
from tests.conftest import rows

RATE_ROW = "run long, rec long, time double, count long"
LOG_ROW = "file_id long, seq long, event_number long, ddl_id long, code int"


def arrive(spark, folder, batches, schema):
    """One file per batch, in the order of their time stamps."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def plain_rates(records):
    out = {}
    for run in {r[0] for r in records}:
        before, overflows = None, 0
        for _, rec, at, count in sorted((r for r in records if r[0] == run), key=lambda r: (r[2], r[1])):
            overflows += before is not None and before[1] - count > 1_000_000_000
            total = count + overflows * 2**32
            rate = (total - before[2]) / (at - before[0]) if before and at > before[0] else None
            out[run, rec] = (total, rate)
            before = (at, count, total)
    return [(*k, *v) for k, v in out.items()]


def counter_records():
    rng = random.Random(4)
    records = []
    for run in (1, 2, None):
        count, at = rng.randrange(2**32), 0.0
        for rec in range(60):
            at += rng.randrange(1, 40) / 8
            count = (count + rng.randrange(2**30)) % 2**32
            records.append((run, rec, at, count))
    return records


def test_rates_out_of_order_and_restarted(spark, tmp_path):
    records = counter_records()
    rng = random.Random(1)
    ordered = sorted(records, key=lambda r: r[2] + rng.uniform(0, 30))  # up to 30 s out of order
    batches = [ordered[i : i + 36] for i in range(0, 180, 36)]
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    stream = arrive(spark, source, batches[:2], RATE_ROW)
    flows.batches_to_folder(flows.live_rates(stream, 60), out, "update", progress)
    before = spark.read.parquet(out).count()
    stream = arrive(spark, source, batches[2:], RATE_ROW)
    flows.batches_to_folder(flows.live_rates(stream, 60), out, "update", progress)
    given = spark.read.parquet(out)
    assert given.where("batch < 2").count() == before and given.count() > len(records)
    found = flows.settled(given, ["run", "rec"], "revision")
    got = sorted(map(tuple, found.select("run", "rec", "total", "rate").collect()), key=repr)
    assert got == sorted(plain_rates(records), key=repr)


def test_late_records_change_nothing(spark, tmp_path):
    batches = [
        [(1, 0, 0.0, 10), (1, 1, 100.0, 20)],
        [(1, 3, 200.0, 60), (1, 2, 150.0, 30)],
        [(1, 9, 50.0, 999), (2, 0, 300.0, 7)],  # the first is behind 200 - 60
        [(1, 4, 250.0, 70), (2, 8, 1.0, 5)],  # a new run, but late as well
        [(1, 5, 260.0, 90), (None, 6, None, 1), (1, 7, 270.0, None)],
    ]
    stream = arrive(spark, str(tmp_path / "in"), batches, RATE_ROW)
    flows.batches_to_folder(flows.live_rates(stream, 60), str(tmp_path / "out"), "update")
    found = flows.settled(spark.read.parquet(str(tmp_path / "out")), ["run", "rec"], "revision")
    assert rows(found, "run", "rec", "total", "rate") == [
        (1, 0, 10, None), (1, 1, 20, 0.1), (1, 2, 30, 0.2), (1, 3, 60, 0.6), (1, 4, 70, 0.2), (1, 5, 90, 2.0), (2, 0, 7, None),
    ]


def test_state_keeps_the_delay_only(spark, tmp_path):
    """A run's old records leave the state, so that a late-coming order change cannot reach them."""
    batches = [[(1, i, float(i), i) for i in range(k * 500, k * 500 + 500)] for k in range(3)]
    stream = arrive(spark, str(tmp_path / "in"), batches, RATE_ROW)
    progress = str(tmp_path / "progress")
    flows.batches_to_folder(flows.live_rates(stream, 10), str(tmp_path / "out"), "update", progress)
    state = spark.read.format("statestore").load(progress).select("value.groupState.time").first()[0]
    assert len(state) == 11 and state[-1] == 1499.0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1500


def plain_islands(log):
    out = []
    for file in {r[0] for r in log}:
        number, before = 0, object()
        for row in sorted((r for r in log if r[0] == file), key=lambda r: r[1]):
            if row[2:] != before:
                number += 1
                out.append([file, number, *row[2:], 0])
                before = row[2:]
            out[-1][-1] += 1
    return sorted(map(tuple, out), key=repr)


def test_error_log_out_of_order_and_restarted(spark, tmp_path):
    rng = random.Random(8)
    log = [(i % 3 if i % 7 else None, i, rng.randrange(2), rng.choice([1, None]), 5) for i in range(240)]
    ordered = sorted(log, key=lambda r: r[1] + rng.uniform(0, 20))
    batches = [ordered[i : i + 60] for i in range(0, 240, 60)]
    batches[3] = [*batches[3], (0, 2, 9, 9, 9)]  # late
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in (batches[:1], batches[1:]):
        stream = arrive(spark, source, part, LOG_ROW)
        flows.batches_to_folder(flows.live_error_log(stream, 40), out, "update", progress)
    found = flows.settled(spark.read.parquet(out), ["file_id", "island"], "revision")
    got = [tuple(r) for r in found.select("file_id", "island", *flows.SAME, "n").collect()]
    assert sorted(got, key=repr) == plain_islands(log)
