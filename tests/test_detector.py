"""Event, candidate, counter, ancestry and source rules on small hand-made frames."""

import math
import random
from itertools import pairwise

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.functions import bunchmask, calibration, padrows, tracks, triggers
from eventloom.operators import ancestry, cleaning, conditions, counters, eventwise, machine, ranges, tables
from eventloom.operators import components as groups
from eventloom.session import stored, work_path
from eventloom.sources import nested, sinks, texts
from eventloom.streaming import flows
from tests.conftest import rows

C = F.col
KEYS = ["file_id", "event_idx"]


def one(spark, **columns):
    return spark.createDataFrame([{"_": 1}]).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_flat_eta_has_the_other_sign(spark):
    got = one(spark, a=tracks.eta(F.lit(0.3)), b=tracks.eta_flat(F.lit(0.3)))
    assert got.a == pytest.approx(-got.b) and got.a == pytest.approx(math.asinh(0.3))


def test_no_momentum_without_curvature(spark):
    got = one(spark, pt=tracks.pt(F.lit(0.0)), p=tracks.momentum(F.lit(0.1), F.lit(0.0)))
    assert got.pt is None and got.p is None


def test_impact_without_field_is_that_of_the_line(spark):
    at = [F.lit(v) for v in (10.0, 1.0, 0.4, 0.2, 0.5, 0.3, 0.1)]
    x, y, alpha, snp, c, px, py = at
    got = one(
        spark,
        helix=tracks.impact(x, y, alpha, snp, c, px, py, F.lit(0.0)),
        weak=tracks.impact(x, y, alpha, snp, c, px, py, F.lit(1e-9)),
        line=tracks.linear_impact(x, y, alpha, snp, px, py),
    )
    assert got.helix == got.line and got.weak == pytest.approx(got.line, rel=1e-6)


def test_positional_join_wants_partners(spark):
    a = spark.createDataFrame([(0, 0, 1, 5), (0, 0, 2, 6)], "file_id int, event_idx int, obj_id int, x int")
    b = spark.createDataFrame([(0, 0, 1, 7)], "file_id int, event_idx int, obj_id int, y int")
    assert rows(tables.positional_join(a.where("obj_id = 1"), b), "x", "y") == [(5, 7)]
    with pytest.raises(PySparkException, match="differ in their rows"):
        tables.positional_join(a, b).collect()


def test_row_writer_checks_arity(spark):
    with pytest.raises(ValueError):
        tables.from_rows(spark, [(1, 2), (3,)], ["a", "b"], ["int", "int"])
    assert rows(tables.from_rows(spark, [(1, 2.0)], ["a", "b"], ["int", "double"])) == [(1, 2.0)]


def test_concat_keeps_the_common_columns(spark):
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    b = spark.createDataFrame([(9, 8)], "z int, x int")
    assert tables.concat(a, b).columns == ["x", "z"] and rows(tables.concat(a, b)) == [(1, 3), (8, 9)]


def test_trigger_expression(spark):
    df = spark.createDataFrame([(["A-B", "C"], ["A-B", "C", "D"]), ([], ["A-B"])], "f array<string>, d array<string>")

    def ask(text):
        return [r.v for r in df.select(triggers.expression(text, "f", "d").alias("v")).collect()]

    assert ask("A-B && !D || C") == [True, True]  # the second event does not define D and C
    assert ask("D | (A-B & D)") == [False, True]
    assert ask("A-B") == [True, False]
    assert ask("A-B &&") == ask("") == ask("(A-B") == [True, True]


def test_hlt_name_is_followed_by_a_blank(spark):
    df = spark.createDataFrame([("1", "fired ABC now"), ("0", "ABC now"), ("1", "ABC"), ("1", "ABCD ABC x")], "o string, d string")
    assert [r.v for r in df.select(triggers.hlt_fired(C("o"), C("d"), "ABC").alias("v")).collect()] == [True, False, False, False]


def test_sign_bit_counts_as_a_flag(spark):
    got = one(spark, v=triggers.any_bit(F.lit(-(2**63)), -(2**63)), w=triggers.free_tracklet(F.lit(2**62), 1))
    assert got.v and not got.w


@pytest.mark.parametrize("text, found", [("3564L", 3564), ("3564h", 0), ("25L 25(2H2LH 3(23HL)) 1614H", 25 + 25 * 5)])
def test_bunch_mask(text, found):
    assert bunchmask.expand(text).count("L") == found


@pytest.mark.parametrize("text", ["3563L", "3565L", "3564X", "2(1782L", "9999999(9999H)"])
def test_malformed_bunch_mask(spark, text):
    with pytest.raises(ValueError):
        bunchmask.expand(text)
    assert one(spark, v=bunchmask.unmasked(F.lit(text))).v is None


def test_masks_are_decoded_in_several_tasks(spark):
    from eventloom.plans import QUERIES

    folder = work_path(spark, "masks")
    spark.range(200).select(C("id").alias("p_partkey"), (C("id") % 50 + 1).alias("p_size")).coalesce(1).write.parquet(f"{folder}/part.parquet")
    got = QUERIES["i04_bunch_mask"](spark, folder)
    assert got.rdd.getNumPartitions() > 4
    assert rows(got.where("mask_id % 50 < 2")) == sorted(
        ((i, 3564 - (i % 50 + 1 + 12 * ((i % 50 + 1) % 9 + 1)), i % 2 == 1) for i in (*range(0, 200, 50), *range(1, 200, 50))), key=repr
    )
    texts = spark.createDataFrame([(0, "3564L"), (1, None), (2, "x"), (3, "3564H"), (4, "3560H4L")], "i int, t string").coalesce(1)
    assert rows(texts.select("i", bunchmask.unmasked(C("t")).alias("open")).where("i > 0")) == [(1, None), (2, None), (3, []), (4, [3560, 3561, 3562, 3563])]


def test_centroid_without_energy_is_null(spark):
    got = one(spark, x=calibration.neutron_centroid(F.array(*[F.lit(0.0)] * 4), F.lit(1.0))[0])
    assert got.x is None


def test_beam_species(spark):
    names = {"p-p": "pp", "PROTON-PROTON": "pp", "Pb-Pb": "ions", "A-A": "ions", "p-Pb": "p_ion", "Pb-p": "ion_p", "Xe-Xe": None}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.s for r in df.select("n", calibration.beam_species(C("n")).alias("s")).collect()} == names


def test_fallback_covers_the_boundary_run(spark):
    got = one(spark, a=eventwise.with_fallback(F.lit(200000), F.lit(1), F.lit(2)))
    assert got.a == 2


def test_event_plane_without_signal_is_null(spark):
    silent = F.array(*[F.lit(0.0)] * 64)
    assert one(spark, v=eventwise.event_plane(silent, 10, 3)).v is None


def pad_reference(hits, n, row0, row1, both):
    findable, last = 0, -n
    for i in range(row0, min(len(hits), row1)):
        after = any(hits[i + 1 : i + 1 + n])
        if hits[i]:
            last = i
            findable += 1
        else:
            before = i - last <= n
            findable += (before and after) if both else (before or after)
    return findable


def test_findable_rows(spark):
    rng = random.Random(7)
    tracks_ = [([rng.random() < 0.4 for _ in range(40)],) for _ in range(30)]
    df = spark.createDataFrame(tracks_, "h array<boolean>")
    for row0, row1, both in ((0, 40, False), (3, 30, False), (0, 159, True)):
        got = df.select("h", padrows.findable_rows(C("h"), 3, row0, row1, both).alias("v")).collect()
        assert [r.v for r in got] == [pad_reference(r.h, 3, row0, row1, both) for r in got]


# --- counters -------------------------------------------------------------------


def test_overflow_and_real_decrease(spark):
    top = 2**32
    data = [(1, t, t, c, c) for t, c in enumerate([5, top - 10, 20, 30])] + [(2, t, t, c, c) for t, c in enumerate([100, 50])]
    df = spark.createDataFrame(data, "run int, t bigint, rec int, a bigint, b bigint")
    got = counters.corrected(df, ["run"], ["t", "rec"], F.floor(C("t") / 2), ["a", "b"])
    assert rows(got.where("run = 1"), "t", "a_total") == [(0, 5), (1, top - 10), (2, top + 20), (3, top + 30)]
    checked = got.withColumn("code", counters.verdict(["a", "b"], ["t"]))
    assert rows(checked.where("code <> 0"), "run", "code") == [(2, 2)]
    assert rows(counters.consistent_runs(checked, ["run"]).select("run").distinct()) == [(1,)]


def test_level_may_exceed_the_previous_one_a_little(spark):
    def code(b, c, d):
        df = spark.createDataFrame([(1, 0, 0, 0, 0, 0, 0), (1, 1, 1, 100, b, c, d)], "run int, t int, rec int, a bigint, b bigint, c bigint, d bigint")
        got = counters.corrected(df, ["run"], ["t", "rec"], F.lit(0), ["a", "b", "c", "d"])
        return got.where("t = 1").select(counters.verdict(["a", "b", "c", "d"], ["t"]).alias("v")).first().v

    assert [code(115, 100, 90), code(116, 100, 90), code(90, 602, 500), code(90, 603, 500)] == [0, 1, 0, 1]


def test_pile_up_limits(spark):
    sure = counters.pile_up(F.lit(100), F.lit(100.0), F.lit(0), F.lit(0.0))
    none = counters.pile_up(F.lit(0), F.lit(0.0), F.lit(0), F.lit(0.0))
    some = counters.pile_up(F.lit(10), F.lit(100.0), F.lit(0), F.lit(0.0), 0.5)
    got = one(spark, a=sure[0], b=none[0], c=some[0])
    assert got.a is None and got.b is None and got.c == pytest.approx(-math.log(0.9) / 0.5)


def test_changes_compare_with_the_record_before(spark):
    data = [(0, i, v) for i, v in enumerate(["a", "a", "b", "a", "a"])]
    df = spark.createDataFrame(data, "k int, t bigint, v string")
    assert rows(machine.changes_only(df, ["k"], ["t"], F.floor(C("t") / 2), "v"), "t") == [(0,), (2,), (3,)]


def test_mean_intensity_starts_at_zero(spark):
    rec = spark.createDataFrame([(0, [1.0, 2.0, -5.0]), (0, [3.0, 4.0, 6.0])], "k int, values array<double>")
    conf = spark.createDataFrame([(0, [-1, 11, 21])], "k int, bunches array<int>")
    got = machine.mean_intensity(rec, conf, None, ["k"], 0).first()
    assert (got.colliding, got.noncolliding, got.n_records) == (2.0, 6.0, 2)


# --- conditions -----------------------------------------------------------------


def test_any_range_and_duplicate_top_entries(spark):
    entries = spark.createDataFrame(
        [(1, "a", -1, -1, 1, 0), (2, "a", 10, 20, 2, 1), (3, "a", 15, 15, 2, 1)],
        "entry int, path string, first_run int, last_run int, version int, sub_version int",
    )
    asked = spark.createDataFrame([(i, "a", r) for i, r in enumerate((5, 10, 20, 15))], "request int, path string, run bigint")
    got = conditions.best_version(asked, entries, ["path"], ["request"])
    assert rows(got, "request", "entry", "n_top") == [(0, 1, 1), (1, 2, 1), (2, 2, 1), (3, 2, 2)]


def test_enclosing_range_overlaps(spark):
    old = spark.createDataFrame([(1, "a", 10, 20)], "entry int, k string, lo bigint, hi bigint")
    new = spark.createDataFrame([(i, "a", *r) for i, r in enumerate([(5, 30), (20, 25), (21, 25), (10, 12)])], "n int, k string, new_lo bigint, new_hi bigint")
    assert rows(conditions.overlapping(new, old, ["k"], ["n"]), "n", "entry") == [(0, 1), (1, 1), (3, 1)]


def test_best_entries_are_found_without_pairs(spark, monkeypatch):
    draw = random.Random(11)

    def span(low=-20, high=40):
        a = draw.randrange(low, high)
        return draw.choice([(-1, -1), (a, a + draw.randrange(-2, 30)), (a, None), (a, a), (5, 2**40)])

    entries = [(i if i % 9 else None, draw.choice("ab"), *span(), draw.choice([0, 1, 2, None]), draw.randrange(3)) for i in range(150)]
    asked = [(i, draw.choice("abc"), draw.choice([None, draw.randrange(-25, 70)]), draw.randrange(4)) for i in range(80)]
    asked += [(0, "a", 7, 1), *asked[:3]]
    catalogue = spark.createDataFrame(entries, "entry int, path string, first_run bigint, last_run bigint, version int, sub_version int")
    requests = spark.createDataFrame(asked, "request int, path string, run bigint, wanted int")

    def valid(r):
        for e in entries:
            lo, hi = (0, 2**31 - 1) if e[2] is not None and e[3] is not None and e[2] < 0 and e[3] < 0 else e[2:4]
            if e[1] == r[1] and None not in (lo, hi, r[2]) and lo <= r[2] <= hi:
                yield e

    def order(e):
        return tuple(-1 if v is None else v for v in e[4:6])

    def best(chosen):
        out = {}
        for r in asked:
            out.setdefault(r[0], []).extend(e for e in valid(r) if chosen(r, e))
        found = []
        for request, hits in out.items():
            if hits:
                top = max(map(order, hits))
                firsts = [e for e in hits if order(e) == top]
                least = min((e[0] for e in firsts if e[0] is not None), default=None)
                # entries without a number give no fields
                found.append((request, *(firsts[0][4:6] if least is not None else (None, None)), least, len(firsts)))
        return sorted(found, key=repr)

    def no_pairs(*_, **__):
        raise AssertionError("pairs are formed")

    monkeypatch.setattr(conditions, "range_join", no_pairs)
    columns = ("request", "version", "sub_version", "entry", "n_top")
    got = conditions.best_version(requests, catalogue, ["path"], ["request"])
    assert rows(got, *columns) == best(lambda r, e: True)
    got = conditions.best_version(requests, catalogue, ["path"], ["request"], version=C("wanted"))
    assert rows(got, *columns) == best(lambda r, e: e[4] is not None and e[4] == r[3])
    rules = catalogue.select("path", "first_run", "last_run", C("entry").alias("rule_pos"), C("sub_version").alias("rule_version"))
    want = {r[0]: [] for r in asked}
    for r in asked:
        want[r[0]] += [(e[0], e[5]) for e in valid(r) if e[0] is not None]
    got = conditions.apply_rules(requests, rules, ["path"], ["request"]).select("request", "rule_version").distinct()
    assert rows(got) == sorted(((k, min(v)[1] if v else None) for k, v in want.items()), key=repr)
    layers = [("x", catalogue.where("entry % 5 = 0")), ("y", catalogue.where("entry % 2 = 0 AND version IS NOT NULL"))]
    ranked = {}
    for r in asked:
        ranked.setdefault(r[0], [(-9,)])
        for e in valid(r):
            if e[0] is not None:
                ranked[r[0]] += [(0, *order(e), -e[0], "x", e[0])] * (e[0] % 5 == 0)
                ranked[r[0]] += [(-1, *order(e), -e[0], "y", e[0])] * (e[0] % 2 == 0 and e[4] is not None)
    got = conditions.layered(requests, layers, ["path"], ["request"]).select("request", "layer", "entry").distinct()
    assert rows(got) == sorted(((k, *(max(v)[4:] or (None, None))) for k, v in ranked.items()), key=repr)


def test_best_overlap_is_found_without_pairs(spark, monkeypatch):
    draw = random.Random(12)

    def some(n):
        starts = [draw.choice([None, *range(-9, 30)]) for _ in range(n)]
        return [(i, draw.choice("ab"), a, draw.choice([None, a and a + draw.randrange(-3, 12), 2**35])) for i, a in enumerate(starts)]

    new = spark.createDataFrame(some(60), "n int, k string, new_lo bigint, new_hi bigint")
    old = spark.createDataFrame(some(90), "entry int, k string, lo bigint, hi bigint").withColumns({"version": C("entry") % 3, "sub_version": C("entry") % 5})
    pairs = conditions.overlapping(new, old, ["k"], ["n"])
    least = rows(pairs.groupBy("n").agg(F.min("entry")))
    most = rows(pairs.groupBy("n").agg(F.max(F.struct("version", "sub_version")).alias("top")).select("n", "top.*"))
    monkeypatch.setattr(conditions, "range_join", None)
    assert rows(conditions.overlapping(new, old, ["k"], ["n"], best=(C("entry"), -C("entry"))), "n", "best") == least
    got = conditions.next_version(new, old, ["k"], ["n"]).where("next_sub_version > 0")
    assert rows(got.select("n", "next_version", C("next_sub_version") - 1)) == most and len(most) > 20


def test_object_of_a_run_and_pass_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(conditions, "range_join", None)
    objects = spark.createDataFrame(
        [("a", 1, 0, 9, ""), ("a", 2, 5, 20, "p1"), ("a", 3, 5, 20, "p2"), ("a", 4, 8, 8, ""), ("b", 5, 9, 1, "")],
        "name string, entry_idx int, lower bigint, upper bigint, pass string",
    )
    asked = [("a", 1, 0, "p1"), ("a", 2, 6, "p1"), ("a", 3, 8, "p1"), ("a", 4, 15, ""), ("b", 5, 5, "p1"), ("a", 6, 6, None), ("c", 7, 6, "p1"), ("a", 8, 12, "p2")]
    requests = spark.createDataFrame(asked, "name string, request int, run bigint, wanted_pass string")
    defaults = spark.createDataFrame([("a", 70), ("b", 71)], "name string, default_idx int")
    got = conditions.object_for_run(requests, objects, defaults, ["name"], ["request"])
    assert rows(got, "request", "entry_idx") == [(1, 1), (2, 2), (3, 4), (4, 70), (5, 71), (6, 1), (7, None), (8, 3)]


def test_entry_names(spark):
    df = spark.createDataFrame([("Run0_99_v2_s1.root",), ("Run0_99_v2.root",), ("run0_9_v1_s1.root",)], "n string")
    got = [r.e and tuple(r.e) for r in df.select(conditions.parse_entry_name(C("n")).alias("e")).collect()]
    assert got == [(0, 99, 2, 1), None, None]


# --- cleaning -------------------------------------------------------------------


def test_kinks_spare_each_other_in_chains(spark):
    left = spark.createDataFrame([(0, 0, i) for i in (1, 2, 3, 5, 6)], "file_id int, event_idx int, obj_id bigint")
    kinks = spark.createDataFrame([(0, 0, 1, 2), (0, 0, 2, 3), (0, 0, 3, 4), (0, 0, 5, 6)], "file_id int, event_idx int, mother_id bigint, daughter_id bigint")
    assert rows(cleaning.spare_kinks(left, kinks, KEYS), "obj_id") == [(5,), (6,)]


def kink_reference(candidates, kinks):
    left = set(candidates)
    while True:
        spared = {x for a, b in kinks for x, other in ((a, b), (b, a)) if other not in left} & left
        if not spared:
            return left
        left -= spared


def test_kinks_of_any_shape_equal_the_fixed_point(spark):
    draw = random.Random(5)
    ids, links = range(300), [(draw.randrange(300), draw.randrange(300)) for _ in range(130)]
    links += [(7, 7), (8, None), (None, 9), (10, 11), (10, 11)]
    candidates = [i for i in ids if draw.random() < 0.9]
    left = spark.createDataFrame([(e, 0, i) for e in (0, 1) for i in candidates], "file_id int, event_idx int, obj_id bigint")
    kinks = spark.createDataFrame([(1, 0, a, b) for a, b in links], "file_id int, event_idx int, mother_id bigint, daughter_id bigint")
    want = kink_reference(candidates, links)
    got = cleaning.spare_kinks(left, kinks, KEYS)
    assert 100 < len(want) < len(candidates)
    assert rows(got, "file_id", "obj_id") == sorted([(0, i) for i in candidates] + [(1, i) for i in want], key=repr)
    assert rows(cleaning.spare_kinks(left, kinks.where("false"), KEYS), "file_id", "obj_id") == sorted(((e, i) for e in (0, 1) for i in candidates), key=repr)
    assert not cleaning.spare_kinks(left.where("false"), kinks, KEYS).collect()


@pytest.mark.parametrize("shuffled", [False, True])
def test_long_chains_take_few_rounds(spark, shuffled, monkeypatch):
    names = list(range(1000))
    if shuffled:
        random.Random(3).shuffle(names)
    links = spark.createDataFrame([(0, 0, a, b) for a, b in pairwise(names)], "file_id int, event_idx int, a bigint, b bigint")
    writes = []
    monkeypatch.setattr(groups, "stored", lambda df, name: writes.append(name) or stored(df, name))
    got = groups.components(links, KEYS)
    assert rows(got, "obj_id", "root") == sorted(((i, 0) for i in range(1000)), key=repr)
    assert len(writes) - 1 <= 12


def merge_reference(vertices, cut):
    """Every pair of an event, from the largest vertex down."""
    order = sorted(vertices, key=lambda v: (-v["n_indices"], v["obj_id"]))
    for v in order:
        v["gone"] = False
    for i, big in enumerate(order):
        if big["gone"]:
            continue
        near = []
        for small in order[i + 1 :]:
            if small["gone"]:
                continue
            d = [big[a] - small[a] for a in "xyz"]
            xx, xy, yy, zz = (big[c] + small[c] for c in ("cov_xx", "cov_xy", "cov_yy", "cov_zz"))
            square = (yy * d[0] ** 2 + xx * d[1] ** 2 - 2 * xy * d[0] * d[1]) / (xx * yy - xy * xy) + d[2] ** 2 / zz
            near.append(((math.sqrt(square) if square > 0 else -1) * small["n_indices"], small))
        for distance, small in sorted(near, key=lambda p: p[0]):
            if distance < cut:
                if big["bunch"] == cleaning.UNKNOWN_BUNCH:
                    big["bunch"] = small["bunch"]
                if small["bunch"] in (big["bunch"], cleaning.UNKNOWN_BUNCH):
                    small["gone"] = True
    return [(v["event_idx"], v["obj_id"], v["bunch"], v["gone"]) for v in order]


def test_split_vertices(spark):
    rng = random.Random(8)
    data, want = [], []
    for event in range(12):
        found = [
            {
                "file_id": 0, "event_idx": event, "obj_id": i, "x": rng.gauss(0, 0.02), "y": rng.gauss(0, 0.02),
                "z": rng.uniform(-8, 8), "cov_xx": 0.002, "cov_xy": 0.0005, "cov_yy": 0.001, "cov_zz": rng.choice([0.01, 0.04]),
                "n_indices": rng.randrange(1, 30), "bunch": rng.choice([-100, 0, 1]),
            }
            for i in range(rng.choice([1, 3, 25]))
        ]
        data += [dict(v) for v in found]
        want += merge_reference(found, cleaning.SPLIT_DISTANCE)
    merged = cleaning.merge_split_vertices(spark.createDataFrame(data), KEYS)
    assert rows(merged, "event_idx", "obj_id", "bunch", "discarded") == sorted(want, key=repr)
    best = {}
    for event, ident, bunch, gone in want:
        size = next(v["n_indices"] for v in data if v["event_idx"] == event and v["obj_id"] == ident)
        if not gone and bunch in (0, -100):
            best[event] = max(best.get(event, ()), (bunch == 0, size, -ident))
    chosen = cleaning.primary_vertex(merged, KEYS).where("is_primary")
    assert rows(chosen, "event_idx", "obj_id") == sorted(((e, -b[2]) for e, b in best.items()), key=repr)


# --- ancestry -------------------------------------------------------------------

PARTICLE = "file_id int, event_idx int, idx bigint, mother bigint, pdg int, status int, process int, vx double, vy double, vz double"


def forest(spark, data):
    return spark.createDataFrame([(0, 0, i, *r, 0.0, 0.0, 0.0) for i, r in enumerate(data)], PARTICLE)


def test_long_chain_has_one_root(spark):
    df = forest(spark, [(i - 1, 211, 1, 0) for i in range(70)])
    assert rows(ancestry.roots(df, KEYS).select("root").distinct()) == [(0,)]


def test_family_of_a_long_chain_in_few_rounds(spark, monkeypatch):
    df = forest(spark, [(i - 1 if i % 1000 else -1, 211, 1, 0) for i in range(2000)])
    writes = []
    monkeypatch.setattr(ancestry, "stored", lambda df, name: writes.append(name) or stored(df, name))
    got = ancestry.with_family(df, df.where("idx IN (998, 400, 1003)"), KEYS)
    assert rows(got, "idx") == sorted(((i,) for i in [*range(999), 1000, 1001, 1002, 1003]), key=repr)
    assert len(writes) - 1 <= 12


def test_family_ends_at_missing_mothers_and_refuses_circles(spark):
    df = forest(spark, [(-1, 211, 1, 0), (77, 211, 1, 0), (1, 211, 1, 0)])
    assert rows(ancestry.with_family(df, df.where("idx = 2"), KEYS), "idx") == [(1,), (2,)]
    assert not ancestry.with_family(df, df.where("false"), KEYS).collect()
    ring = forest(spark, [(2, 211, 1, 0), (0, 211, 1, 0), (1, 211, 1, 0)])
    with pytest.raises(ValueError, match="circle"):
        ancestry.with_family(ring, ring.where("idx = 1"), KEYS)


def test_pruning_renumbers_and_checks_mothers(spark):
    #           0 and 1 generated; 2 from 0 far out; 3 from 1 by decay; 4 from 3 by decay; 5 from 2
    df = forest(spark, [(-1, 211, 1, 0), (-1, 421, 1, 0), (0, 11, 1, 0), (1, 321, 1, 4), (3, 211, 1, 4), (2, 22, 1, 0)])
    df = df.withColumn("vx", F.when(C("idx") == 2, 99.0).otherwise(C("vx")))
    events = spark.createDataFrame([(0, 0, 2)], "file_id int, event_idx int, n_primary bigint")
    nothing = df.where("false")
    got = ancestry.pruned(df, events, nothing, KEYS, 10.0, 10.0)
    assert rows(got, "idx", "new_idx", "new_mother", "new_first") == [(0, 0, -1, -1), (1, 1, -1, 2), (3, 2, 1, 3), (4, 3, 2, -1)]
    kept = ancestry.pruned(df, events, df.where("idx = 5"), KEYS, 10.0, 10.0)
    assert rows(kept, "idx") == [(i,) for i in range(6)]


# --- sources --------------------------------------------------------------------


def write_text(spark, name, *lines):
    path = work_path(spark, name)
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def test_counter_file(spark):
    path = write_text(
        spark, "cnt", "# head", "3", "77 2 5 9", "1 2 3 4 6", "1 2 3 4 5 6 7 8", "11 12 13 14 15 16 17 18", "# mid",
        "9 2 4 0", "2 3 4 5 6 7 8 9", "12 13 14 15 16 17 18 19",
    )
    got = texts.read_counters(spark, path)
    assert rows(got, "run", "rec", "class_idx", "orbit", "l0b", "lma", "time_group") == [
        (77, 0, 5, 1, 1, 8, 6), (77, 0, 9, 1, 11, 18, 6), (77, 1, 5, 9, 2, 9, None), (77, 1, 9, 9, 12, 19, None)
    ]


@pytest.mark.parametrize("bad", ["1 2 3", "1 2 3 4 5 6 7"])
def test_malformed_counter_file(spark, bad):
    path = write_text(spark, "cnt", "2", "77 1 5", "1 2 3 4", bad)
    with pytest.raises(PySparkException, match="malformed"):
        texts.read_counters(spark, path).collect()


def test_slow_control_file(spark):
    path = write_text(
        spark, "dp", "0\ta/b\ti:2\t2\t1\t2\t10.0\t3\t4\t20.0", "END_OF_BLOCK\tx\ty:1\t1", "1\tflag\tb:1\t1\t7\t15.0",
        "2\tname\ts:1\t1\thello\t16.5", "3\tshort", "4\tlate\tf:1\t1\t2.5\t99.0",
    )
    got = texts.read_slow_control(spark, path, 5.0, 50.0)
    assert rows(got, "name", "ts", "numbers", "texts") == [
        ("a/b", 10.0, [1.0, 2.0], None), ("a/b", 20.0, [3.0, 4.0], None), ("flag", 15.0, [1.0], None), ("name", 16.5, None, ["hello"])
    ]
    assert rows(texts.read_slow_control(spark, path, alias="late"), "numbers") == [([2.5],)]


def small_events(spark, sizes, size=nested.FRAGMENT):
    """Events with the given numbers of tracks, spread over fragments of ``size``."""
    names = [f.split()[:2] for f in nested.HEADER.split(", ")]
    header = F.struct(
        *[(F.lit(i) if t in ("double", "bigint") else F.array(*[F.lit(k == 1) for k in range(64)])).cast(t).alias(n) for i, (n, t) in enumerate(names)]
    )
    headers = spark.createDataFrame([(i % 2, i) for i in range(len(sizes))], "file_id bigint, event_idx bigint").withColumn("header", header)
    ids = [(i % 2, i, k) for i, n in enumerate(sizes) for k in range(n)]
    base = spark.createDataFrame(ids, "file_id bigint, event_idx bigint, obj_id bigint")

    def filled(fields):
        rest = [f.split() for f in fields.split(", ")[1:]]
        values = {"array<double>": F.array(*[F.lit(float(v)) for v in range(15)]), "string": F.lit("phos")}
        return base.select("*", *[values.get(t, F.lit(2)).cast(t).alias(n) for n, t in rest])

    objects = {n: filled(d) for n, d in (("tracks", nested.TRACK), ("cells", nested.CELL), ("muons", nested.MUON))}
    return nested.nest(headers, objects, size)


def test_long_events_come_in_fragments(spark):
    events = small_events(spark, [0, 3, 100], size=10)
    assert events.where("event_idx = 2").count() > 5
    assert events.select(F.max(F.size("tracks"))).first()[0] < 40
    flat = nested.flatten(events)
    counts = {n: df.count() for n, df in flat.items()}
    assert counts["TRACKPAR"] == counts["CALO"] == counts["MUON"] == 103
    assert counts["COLLISION"] == counts["VZERO"] == 3 and counts["TIMEFRAME"] == 2
    assert flat["TRACKPAR"].select("event_idx", "obj_id").distinct().count() == 103


def test_nesting_shuffles_every_table_once(spark, capsys):
    keys = "file_id bigint, event_idx bigint"
    headers = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (0, 3), (None, 4)], keys).withColumn("header", F.struct("event_idx"))
    ids = [(0, 1, 5), (0, 1, 5), (0, 1, 6), (0, 1, None), (0, 2, 7), (0, 9, 8), (None, 4, 9)] + [(0, 3, i) for i in range(40)]
    base = spark.createDataFrame(ids, f"{keys}, obj_id bigint")
    first, second = base.withColumn("a", C("obj_id") * 2), base.where("obj_id <> 6").withColumn("b", C("obj_id") + 1)
    records = nested.nest(headers, {"pairs": [first, second], "single": base.withColumn("c", F.lit(1))}, size=10)
    capsys.readouterr()
    records.explain()
    lines = capsys.readouterr().out.splitlines()
    wide = [line for line in lines if "Exchange hashpartitioning" in line and "fragment" in line]
    assert len(wide) == 4  # the headers and three tables
    found = records.select("event_idx", "fragment", F.explode_outer("pairs.a").alias("a")).groupBy("event_idx").agg(
        F.count("a").alias("n"), F.count_distinct("fragment").alias("f")
    )
    # of a repeated object all pairs, of a repeated header all pairs of fragment 0, as in joins
    assert rows(found) == [(1, 4 * 4, 1), (2, 1, 1), (3, 39, 4)]
    assert rows(records.where("event_idx = 2"), "header", "pairs", "single") == [((2,), [(7, 14, 8)], [(7, 1)])]
    single = records.where("event_idx = 1").select(F.size("single").alias("n"))
    assert rows(single) == [(4,)] * 4


def test_collision_values_go_by_name(spark):
    row = nested.collisions(small_events(spark, [1])).first()
    at = [f.split()[0] for f in nested.HEADER.split(", ")]
    assert (row.fX, row.fY, row.fCovYY, row.fN) == (at.index("x"), at.index("y"), at.index("cov_yy"), at.index("n_tracks"))
    assert nested.vzeros(small_events(spark, [1])).first().fBBFlag == 2
    calo = nested.calos(small_events(spark, [1])).first()
    assert (calo.fCellType, calo.fType) == (2, 1)


def test_empty_tables_are_not_written(spark):
    flat = nested.flatten(small_events(spark, [0, 0]))
    folder = work_path(spark, "tables")
    names = sinks.write_tables(flat, folder)
    assert set(names) == {"VZERO", "COLLISION", "TIMEFRAME"}
    assert sinks.profile(sinks.read_tables(spark, folder, names)).count() == 3


def test_record_stream_rejects_another_type(spark):
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([("a", 1, None), ("b", 2, 2.0)], "s string, i int, v double")
    with pytest.raises(TypeError):
        sinks.write_streams(df, "s", StructType.fromDDL("i bigint, v double"), work_path(spark, "st"))
    folder = work_path(spark, "st")
    sinks.write_streams(df, "s", StructType.fromDDL("i int, v double"), folder, keep_nulls=False)
    assert rows(sinks.read_streams(spark, folder), "i", "s") == [(2, "b")]


def test_event_limit_and_suffix(spark):
    folder = work_path(spark, "ev")
    small_events(spark, [1] * 10).write.parquet(folder)
    events = nested.read_events(spark, folder)
    assert events.count() == 10 and nested.read_events(spark, folder, ".none").count() == 0
    assert rows(nested.first_events(events, 2, F.lit(0)), "file_id", "event_idx") == [(0, 0), (0, 2), (1, 1), (1, 3)]
    assert nested.first_events(events, 0, F.lit(0)).count() == 10


# --- streaming ------------------------------------------------------------------


def test_rates_over_several_batches(spark):
    folder = work_path(spark, "in")
    top = 2**32
    data = [(1, i, float(i), c) for i, c in enumerate([10, top - 5, 20, 40])]
    for part in (data[:2], data[2:]):
        spark.createDataFrame(part, "run bigint, rec bigint, time double, count bigint").coalesce(1).write.mode("append").parquet(folder)
    stream = flows.file_stream(spark, folder, "*.parquet", files_per_trigger=1)
    out = work_path(spark, "out")
    flows.batches_to_folder(flows.live_rates(stream, 3600), out, "update")
    got = rows(flows.settled(spark.read.parquet(out), ["run", "rec"], "revision"), "rec", "total", "rate")
    assert got == [(0, 10, None), (1, top - 5, top - 15.0), (2, top + 20, 25.0), (3, top + 40, 20.0)]


def test_error_runs_go_on_across_batches(spark):
    folder = work_path(spark, "in")
    log = [(0, i, e, 1, c) for i, (e, c) in enumerate([(5, 1), (5, 1), (5, 1), (5, 2), (6, 2), (6, 2)])]
    for part in (log[:2], log[2:5], log[5:]):
        spark.createDataFrame(part, "file_id bigint, seq bigint, event_number bigint, ddl_id bigint, code int").coalesce(1).write.mode("append").parquet(folder)
    out = work_path(spark, "out")
    stream = flows.file_stream(spark, folder, "*.parquet", files_per_trigger=1)
    flows.batches_to_folder(flows.live_error_log(stream, 3600), out, "update")
    got = flows.settled(spark.read.parquet(out), ["file_id", "island"], "revision")
    assert rows(got, "island", "event_number", "code", "n") == [(1, 5, 1, 3), (2, 5, 2, 1), (3, 6, 2, 2)]


def crowd(n, seed, broken=False):
    """One event whose vertices all lie in one stretch along z."""
    rng = random.Random(seed)
    return [
        {
            "file_id": 0, "event_idx": 5, "obj_id": i, "x": rng.gauss(0, 0.05), "y": rng.gauss(0, 0.05), "z": rng.uniform(0, n / 400),
            "cov_xx": 0.0 if broken and i % 97 == 0 else 0.002, "cov_xy": 0.0, "cov_yy": 0.001, "cov_zz": 1e-4,
            "n_indices": rng.randrange(1, 30), "bunch": rng.choice([-100, 0, 1, 2]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("broken", [False, True])
def test_crowded_stretches_are_decided_in_rounds(spark, monkeypatch, broken):
    data = crowd(600, 3, broken)
    alone = [{**v, "event_idx": 6} for v in crowd(8, 4)]
    frame = spark.createDataFrame([dict(v) for v in data + alone]).repartition(5)
    small = rows(cleaning.merge_split_vertices(frame, KEYS), "event_idx", "obj_id", "bunch", "discarded")
    monkeypatch.setattr(cleaning, "STRETCH", 10)
    large = rows(cleaning.merge_split_vertices(frame, KEYS), "event_idx", "obj_id", "bunch", "discarded")
    assert large == small and {r[3] for r in large} == {True, False}
    if not broken:
        want = merge_reference(data, cleaning.SPLIT_DISTANCE) + merge_reference(alone, cleaning.SPLIT_DISTANCE)
        assert large == sorted(want, key=repr)
