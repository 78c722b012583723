"""Ordered windows, as-of and range joins against brute force, with a hot key and tiny blocks."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import lookups
from eventloom.operators.asof import asof, nearest_record
from eventloom.operators.ordered import blocked, islands, numbered
from eventloom.operators.ranges import range_join
from eventloom.operators.spacing import spaced
from tests.conftest import rows

C = F.col


def series(seed, n=400, span=300):
    """(key, t, id, v): two thirds of the rows in one key, with equal times and nulls."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.66 else rng.randrange(1, 5), rng.randrange(span), i, rng.choice([None, rng.randrange(9)]))
        for i in range(n)
    ]


SCHEMA = "k int, t bigint, id bigint, v bigint"


def by_key(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_blocked(spark, width):
    data = series(1)
    df = blocked(
        spark.createDataFrame(data, SCHEMA), ["k"], F.floor(C("t") / width), ["t", "id"],
        lag={"before": C("v")}, lead={"after": C("id")}, running={"total": C("v")}, last={"known": C("v")},
    )
    want = []
    for key, group in by_key(data).items():
        total, known = 0, None
        for i, (_, _, ident, v) in enumerate(group):
            total += v or 0
            known = v if v is not None else known
            before = group[i - 1][3] if i else None
            after = group[i + 1][2] if i + 1 < len(group) else None
            want.append((key, ident, before, after, total, known))
    assert rows(df, "k", "id", "before", "after", "total", "known") == sorted(want, key=repr)


@pytest.mark.parametrize("width", [1, 11, 1000])
def test_islands(spark, width):
    data = [(k, t, i, (i // 3) % 2) for k, t, i, _ in series(2)]
    df = islands(
        spark.createDataFrame(data, SCHEMA), ["k"], F.floor(C("t") / width), ["t", "id"], {"v": C("v")},
        lambda: C("v") != C("_prev_v"), uses=["v"],
    )
    want = []
    for key, group in by_key(data).items():
        island = 0
        for i, r in enumerate(group):
            island += i == 0 or r[3] != group[i - 1][3]
            want.append((key, r[2], island))
    assert rows(df, "k", "id", "island") == sorted(want, key=repr)


def test_numbered_over_struct_blocks(spark):
    data = [(0, t % 3, t, t) for t in range(50)]
    block = F.struct("t", F.floor(C("id") / 10))
    df = numbered(spark.createDataFrame(data, SCHEMA), ["k"], block, ["t", "id"])
    want = [(r[2], i + 1) for i, r in enumerate(sorted(data, key=lambda r: (r[1], r[2])))]
    assert rows(df, "id", "rank") == sorted(want, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, direction, strict):
    left, right = series(3, 200), series(4, 150)
    found = asof(
        spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"], C("t"), C("t"), 13,
        direction=direction, strict=strict, right_order=["id"],
    )
    want = []
    for k, t, ident, _ in left:
        usable = [
            (r[1], r[2])
            for r in right
            if r[0] == k and (r[1] == t and not strict or (r[1] < t if direction == "backward" else r[1] > t))
        ]
        pick = None if not usable else (max(usable) if direction == "backward" else min(usable))
        want.append((ident, pick and pick[1]))
    assert rows(found.select("id", C("match.id").alias("m"))) == sorted(want, key=repr)


def test_nearest_record_is_empty_outside_the_records(spark):
    records = spark.createDataFrame([(1, 10, 0), (1, 20, 1), (1, 30, 2)], "k int, t bigint, id bigint")
    probes = spark.createDataFrame([(1, p) for p in (9, 10, 25, 30, 31)], "k int, p bigint")
    found = nearest_record(probes, records, ["k"], C("p"), C("t"), 5, ["id"])
    got = {r.p: (r.lower and r.lower.t, r.upper and r.upper.t) for r in found.collect()}
    assert got == {9: (None, None), 10: (10, 20), 25: (20, 30), 30: (30, None), 31: (None, None)}
    # on the last record there is nothing to interpolate to
    counts = found.select("p", lookups.interpolated(C("lower"), C("upper"), F.lit(0), C("p"), "id", "t").alias("c"))
    assert {r.p: r.c for r in counts.collect()}[30] is None


def test_valid_record_falls_back_to_the_first(spark):
    records = spark.createDataFrame([(1, 10.0), (1, 20.0)], "k int, t double")
    asked = spark.createDataFrame([(1, p) for p in (5.0, 10.5, 20.5, 21.0)], "k int, p double")
    found = lookups.valid_record(asked, records, ["k"], C("p"), C("t"), 7.0, 0.9)
    assert {r.p: r.match.t for r in found.collect()} == {5.0: 10.0, 10.5: 10.0, 20.5: 10.0, 21.0: 20.0}


def test_range_join(spark):
    rng = random.Random(5)
    points = [(i, rng.randrange(3), rng.randrange(-50, 100_000)) for i in range(200)]
    spans = [(100, 0, 0, 2**31 - 1), (101, 1, 7, 6)]
    for j in range(100):
        lo = rng.randrange(100_000)
        spans.append((j, rng.randrange(3), lo, lo + rng.choice([0, 3, 500, 60_000])))
    found = range_join(
        spark.createDataFrame(points, "p int, k int, x bigint"),
        spark.createDataFrame(spans, "s int, k int, lo bigint, hi bigint"),
        "x", "lo", "hi", on=["k"], width=4, unmatched=["p"],
    )
    want = []
    for p, k, x in points:
        hits = [(p, s) for s, ks, lo, hi in spans if ks == k and lo <= x <= hi]
        want += hits or [(p, None)]
    assert rows(found, "p", "s") == sorted(want, key=repr)


@pytest.mark.parametrize("block", [60, 600])
def test_spaced(spark, block):
    data = [(k, t, i, 0) for k, t, i, _ in series(6, 500, 2000)]
    found = spaced(spark.createDataFrame(data, SCHEMA), ["k"], "t", "id", 30, block)
    want = []
    for group in by_key(data).values():
        last = None
        for r in group:
            if last is None or r[1] - last >= 30:
                want.append(r)
                last = r[1]
    assert rows(found) == sorted(want, key=repr)
