"""Joins: positional, by link, by validity, as-of, interval, anti and label joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import conditions, embedding, lookups, machine, quality, tables
from eventloom.operators.asof import asof, nearest_record
from eventloom.operators.ordered import numbered
from eventloom.plans.derived import decays
from eventloom.plans.domain import base, table
from eventloom.plans.registry import query, r6

C = F.col
PERIOD = 1 << 24


@query(
    "d01_positional_join",
    """SELECT event_idx, obj_id, tgl, tpc_signal, c_yy FROM tracks JOIN tracks_extra USING (file_id, event_idx, obj_id)
       JOIN tracks_cov USING (file_id, event_idx, obj_id)""",
    ("tracks", "tracks_extra", "tracks_cov"),
)
def positional_join(spark, sf):
    parts = [
        table(spark, sf, "tracks").select(*tables.OBJECT, "tgl"),
        table(spark, sf, "tracks_extra").select(*tables.OBJECT, "tpc_signal"),
        table(spark, sf, "tracks_cov").select(*tables.OBJECT, "c_yy"),
    ]
    return tables.join_all(parts).drop("file_id")


@query(
    "d02_object_to_collision",
    "SELECT event_idx, obj_id, run, z AS vertex_z FROM (SELECT file_id, event_idx, obj_id FROM tracks) JOIN collisions USING (file_id, event_idx)",
    ("tracks", "collisions"),
)
def object_to_collision(spark, sf):
    collisions = table(spark, sf, "collisions").select(*tables.EVENT, "run", C("z").alias("vertex_z"))
    return table(spark, sf, "tracks").select(*tables.OBJECT).join(collisions, tables.EVENT).drop("file_id")


def _leg(spark, sf, link, *columns):
    """Tracks under the name of a link column, their values prefixed by it."""
    named = [C(c).alias(f"{link[:-3]}_{c}") for c in columns]
    return table(spark, sf, "tracks").select(*tables.EVENT, C("obj_id").alias(link), *named)


@query(
    "d03_pair_to_tracks",
    """SELECT d.event_idx, p.tgl AS pos_tgl, n.tgl AS neg_tgl FROM decays d
       JOIN tracks p ON p.event_idx = d.event_idx AND p.obj_id = d.pos_id
       JOIN tracks n ON n.event_idx = d.event_idx AND n.obj_id = d.neg_id""",
    ("decays", "tracks"),
)
def pair_to_tracks(spark, sf):
    df = decays(spark, sf).select(*tables.EVENT, "pos_id", "neg_id")
    for link in ("pos_id", "neg_id"):
        df = df.join(_leg(spark, sf, link, "tgl"), [*tables.EVENT, link])
    return df.select("event_idx", "pos_tgl", "neg_tgl")


@query(
    "d04_cascade_to_tracks",
    """SELECT d.event_idx, p.snp AS pos_snp, n.snp AS neg_snp, b.snp AS bach_snp FROM decays d
       JOIN tracks p ON p.event_idx = d.event_idx AND p.obj_id = d.pos_id
       JOIN tracks n ON n.event_idx = d.event_idx AND n.obj_id = d.neg_id
       JOIN tracks b ON b.event_idx = d.event_idx AND b.obj_id = d.bach_id
       WHERE d.bach_id <> d.pos_id AND d.bach_id <> d.neg_id""",
    ("decays", "tracks"),
)
def cascade_to_tracks(spark, sf):
    found = decays(spark, sf)
    pairs = found.select(*tables.EVENT, C("event_idx").alias("pair_id"), "pos_id", "neg_id")
    cascades = found.where("bach_id <> pos_id AND bach_id <> neg_id").select(
        *tables.EVENT, C("event_idx").alias("pair_id"), "bach_id"
    )
    df = cascades.join(pairs, [*tables.EVENT, "pair_id"])
    for link in ("pos_id", "neg_id", "bach_id"):
        df = df.join(_leg(spark, sf, link, "snp"), [*tables.EVENT, link])
    return df.select("event_idx", "pos_snp", "neg_snp", "bach_snp")


@query(
    "d05_cluster_to_muon",
    """SELECT m.event_idx, m.obj_id, count(*) AS n_clusters, r6(sum(c.amplitude)) AS charge
       FROM muons m JOIN cells c ON c.event_idx = m.event_idx AND c.obj_id = m.obj_id GROUP BY ALL""",
    ("muons", "cells"),
)
def cluster_to_muon(spark, sf):
    clusters = (
        table(spark, sf, "cells")
        .groupBy(*tables.OBJECT)
        .agg(F.count("*").alias("n_clusters"), F.sum("amplitude").alias("charge"))
    )
    muons = table(spark, sf, "muons").select(*tables.OBJECT)
    return muons.join(clusters, tables.OBJECT).select("event_idx", "obj_id", "n_clusters", r6(C("charge")).alias("charge"))


@query(
    "d06_find_by_id",
    "SELECT l_orderkey AS event_idx, p_partkey AS cluster_id, p_size AS pad FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def find_by_id(spark, sf):
    wanted = base(spark, sf, "lineitem").select(C("l_orderkey").alias("event_idx"), C("l_partkey").alias("cluster_id"))
    clusters = base(spark, sf, "part").select(C("p_partkey").alias("cluster_id"), C("p_size").alias("pad"))
    return wanted.join(clusters, "cluster_id")


# --- conditions ---------------------------------------------------------------

REQUESTS = "rq AS (SELECT p_partkey AS request, 290000 + (p_partkey * 7) % 64 AS run, p_type AS l0, p_brand AS l1 FROM part)"
VALID = "((first_run <= run AND run <= last_run) OR (first_run = -1 AND last_run = -1))"
PATH = ["l0", "l1"]


def requests(spark, sf):
    return base(spark, sf, "part").select(
        C("p_partkey").alias("request"),
        (290000 + (C("p_partkey") * 7) % 64).alias("run"),
        C("p_type").alias("l0"),
        C("p_brand").alias("l1"),
    )


@query(
    "d07_best_valid_version",
    f"""WITH {REQUESTS},
       v AS (SELECT request, entry, version, sub_version, rank() OVER (PARTITION BY request ORDER BY version DESC, sub_version DESC) AS r
         FROM rq JOIN catalogue USING (l0, l1) WHERE {VALID})
       SELECT request, any_value(version) AS version, any_value(sub_version) AS sub_version, min(entry) AS entry, count(*) AS n_top
       FROM v WHERE r = 1 GROUP BY request""",
    ("catalogue",),
)
def best_valid_version(spark, sf):
    best = conditions.best_version(requests(spark, sf), table(spark, sf, "catalogue"), PATH, ["request"])
    return best.select("request", "version", "sub_version", "entry", "n_top")


@query(
    "d07_exact_version",
    f"""WITH {REQUESTS}
       SELECT request, max(sub_version) AS sub_version FROM rq JOIN catalogue USING (l0, l1)
       WHERE {VALID} AND version = request % 3 GROUP BY request""",
    ("catalogue",),
)
def exact_version(spark, sf):
    best = conditions.best_version(
        requests(spark, sf), table(spark, sf, "catalogue"), PATH, ["request"], version=C("request") % 3
    )
    return best.select("request", "sub_version")


@query(
    "d08_all_valid_entries",
    f"""WITH {REQUESTS} SELECT request, entry FROM rq JOIN catalogue USING (l0, l1) WHERE {VALID} AND l0 = 'ECONOMY'""",
    ("catalogue",),
)
def all_valid_entries(spark, sf):
    entries = table(spark, sf, "catalogue").where(conditions.path_matches([C("l0"), C("l1")], ["ECONOMY", "*"]))
    return conditions.valid_entries(requests(spark, sf), entries, PATH).select("request", "entry")


RULES = """rules AS (SELECT p_partkey AS rule_pos, p_type AS l0, p_brand AS l1, 290000 + p_partkey % 40 AS first_run,
  290010 + p_partkey % 40 AS last_run, p_partkey % 3 AS rule_version FROM part WHERE p_partkey % 4 = 0)"""


def _rules(spark, sf):
    return (
        base(spark, sf, "part")
        .where("p_partkey % 4 = 0")
        .select(
            C("p_partkey").alias("rule_pos"),
            C("p_type").alias("l0"),
            C("p_brand").alias("l1"),
            (290000 + C("p_partkey") % 40).alias("first_run"),
            (290010 + C("p_partkey") % 40).alias("last_run"),
            (C("p_partkey") % 3).alias("rule_version"),
        )
    )


@query(
    "d09_selection_rules",
    f"""WITH {REQUESTS}, {RULES},
       f AS (SELECT request, arg_min(rule_version, rule_pos) AS rule_version FROM rq JOIN rules USING (l0, l1) WHERE {VALID} GROUP BY request)
       SELECT r.request, f.rule_version, max(c.version * 100 + c.sub_version) AS best
       FROM rq r LEFT JOIN f USING (request) JOIN catalogue c ON r.l0 = c.l0 AND r.l1 = c.l1
         AND ((c.first_run <= r.run AND r.run <= c.last_run) OR (c.first_run = -1 AND c.last_run = -1))
         AND (f.rule_version IS NULL OR c.version = f.rule_version)
       GROUP BY ALL""",
    ("catalogue",),
)
def selection_rules(spark, sf):
    asked = conditions.apply_rules(requests(spark, sf), _rules(spark, sf), PATH, ["request"])
    entries = table(spark, sf, "catalogue")
    # a request without a rule takes any version
    ruled = conditions.best_version(asked.where("rule_version IS NOT NULL"), entries, PATH, ["request"], version=C("rule_version"))
    free = conditions.best_version(asked.where("rule_version IS NULL"), entries, PATH, ["request"])
    best = ruled.unionByName(free)
    return best.select("request", "rule_version", (C("version") * 100 + C("sub_version")).alias("best"))


_LAYERS = {"override": "entry % 7 = 0", "snapshot": "entry % 3 = 0", "store": "entry % 2 = 0"}


@query(
    "d10_layered_lookup",
    f"""WITH {REQUESTS},
       c AS (SELECT *, 'override' AS layer, 0 AS place FROM catalogue WHERE entry % 7 = 0
         UNION ALL SELECT *, 'snapshot', 1 FROM catalogue WHERE entry % 3 = 0
         UNION ALL SELECT *, 'store', 2 FROM catalogue WHERE entry % 2 = 0),
       b AS (SELECT request, layer, entry, row_number() OVER (PARTITION BY request
           ORDER BY place, version DESC, sub_version DESC, entry) AS r FROM rq JOIN c USING (l0, l1) WHERE {VALID})
       SELECT request, layer, entry FROM rq LEFT JOIN (SELECT * FROM b WHERE r = 1) q USING (request)""",
    ("catalogue",),
)
def layered_lookup(spark, sf):
    entries = table(spark, sf, "catalogue")
    layers = [(name, entries.where(condition)) for name, condition in _LAYERS.items()]
    return conditions.layered(requests(spark, sf), layers, PATH, ["request"]).select("request", "layer", "entry")


OBJECTS = """ob AS (SELECT p_partkey AS entry_idx, p_type AS name, 290000 + p_partkey % 50 AS lower, 290000 + p_partkey % 50 + p_size % 9 AS upper,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'pass' || (p_partkey % 3) END AS pass FROM part WHERE p_partkey % 4 = 1)"""
PASS_REQUESTS = """pr AS (SELECT p_partkey AS request, 290000 + (p_partkey * 11) % 70 AS run, p_type AS name,
  'pass' || (p_partkey % 4) AS wanted_pass FROM part)"""


@query(
    "d11_pass_aware_lookup",
    f"""WITH {OBJECTS}, {PASS_REQUESTS},
       df AS (SELECT p_type AS name, min(p_partkey) AS default_idx FROM part WHERE p_size > 10 GROUP BY p_type),
       f AS (SELECT request, max(CASE WHEN pass = '' OR pass = wanted_pass THEN entry_idx END) AS exact,
           max(CASE WHEN pass = '' THEN entry_idx END) AS plain
         FROM pr JOIN ob USING (name) WHERE lower <= run AND run <= upper GROUP BY request)
       SELECT request, coalesce(exact, plain, default_idx) AS entry_idx FROM pr LEFT JOIN f USING (request) LEFT JOIN df USING (name)""",
)
def pass_aware_lookup(spark, sf):
    part = base(spark, sf, "part")
    objects = part.where("p_partkey % 4 = 1").selectExpr(
        "p_partkey AS entry_idx",
        "p_type AS name",
        "290000 + p_partkey % 50 AS lower",
        "290000 + p_partkey % 50 + p_size % 9 AS upper",
        "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('pass', p_partkey % 3) END AS pass",
    )
    asked = part.selectExpr(
        "p_partkey AS request",
        "290000 + (p_partkey * 11) % 70 AS run",
        "p_type AS name",
        "concat('pass', p_partkey % 4) AS wanted_pass",
    )
    defaults = part.where("p_size > 10").groupBy(C("p_type").alias("name")).agg(F.min("p_partkey").alias("default_idx"))
    found = conditions.object_for_run(asked, objects, defaults, ["name"], ["request"])
    return found.select("request", "entry_idx")


@query(
    "d12_reference_class",
    """WITH ref AS (SELECT n_regionkey AS system, 290000 + n_nationkey * 2 AS run_start, n_name AS trigger, n_nationkey / 8.0::DOUBLE AS sigma FROM nation),
       m AS (SELECT c.event_idx, arg_max(ref.trigger, run_start) AS trigger, arg_max(sigma, run_start) AS sigma
         FROM collisions c LEFT JOIN ref ON ref.system = c.config AND run_start <= run GROUP BY c.event_idx)
       SELECT event_idx, CASE WHEN sigma >= 1 THEN trigger END AS trigger, CASE WHEN sigma >= 1 THEN sigma END AS sigma FROM m""",
    ("collisions",),
)
def reference_class(spark, sf):
    ref = base(spark, sf, "nation").select(
        C("n_regionkey").alias("config"),
        (290000 + C("n_nationkey") * 2).cast("bigint").alias("run_start"),
        C("n_name").alias("trigger"),
        (C("n_nationkey") / 8.0).alias("sigma"),
    )
    runs = table(spark, sf, "collisions").select("event_idx", "config", "run")
    found = asof(runs, ref, ["config"], C("run"), C("run_start"), 8)
    known = C("match.sigma") >= 1
    return found.select(
        "event_idx",
        F.when(known, C("match.trigger")).alias("trigger"),
        F.when(known, C("match.sigma")).alias("sigma"),
    )


# --- as-of joins on the counter records -----------------------------------------

# probes are the purchases and signups, records all others of the same run
PROBES = "pb AS (SELECT run, rec AS probe, orbit_abs + 500 AS probe_orbit FROM crossings WHERE kind IN ('purchase', 'signup'))"
RECORDS = """rc AS (SELECT run, rec, orbit_abs, orbit_abs // 40 + rec AS total FROM crossings WHERE kind NOT IN ('purchase', 'signup')),
  lk AS (SELECT *, lead(orbit_abs) OVER w AS next_orbit, lead(total) OVER w AS next_total, lead(rec) OVER w AS next_rec,
    first_value(total) OVER w AS base FROM rc WINDOW w AS (PARTITION BY run ORDER BY orbit_abs, rec))"""
NEAREST = f"""WITH {PROBES}, {RECORDS},
  nr AS (SELECT pb.run, probe, probe_orbit, max(l.rec) AS rec FROM pb LEFT JOIN lk l ON l.run = pb.run AND l.orbit_abs <= probe_orbit GROUP BY ALL),
  br AS (SELECT nr.run, probe, probe_orbit, l.* EXCLUDE (run) FROM nr LEFT JOIN lk l ON l.run = nr.run AND l.rec = nr.rec
    AND (l.next_orbit IS NOT NULL OR l.orbit_abs = nr.probe_orbit))"""


def _nearest(spark, sf):
    rows = table(spark, sf, "crossings").select("run", "rec", "kind", "orbit_abs")
    probes = rows.where("kind IN ('purchase', 'signup')").select("run", C("rec").alias("probe"), (C("orbit_abs") + 500).alias("probe_orbit"))
    total = (F.floor(C("orbit_abs") / 40) + C("rec")).alias("total")
    records = rows.where("kind NOT IN ('purchase', 'signup')").select("run", "rec", "orbit_abs", total)
    return records, nearest_record(probes, records, ["run"], C("probe_orbit"), C("orbit_abs"), PERIOD, ["rec"])


@query("d13_nearest_record", NEAREST + " SELECT run, probe, rec FROM br", ("crossings",))
def nearest(spark, sf):
    return _nearest(spark, sf)[1].select("run", "probe", C("lower.rec").alias("rec"))


@query(
    "d14_record_valid_for",
    """WITH l AS (SELECT run % 16 AS beam, rec, t FROM (SELECT *, us / 1e6 AS t FROM counters) q),
       v AS (SELECT a.beam, a.rec, max(b.rec) AS found FROM l a LEFT JOIN l b ON a.beam = b.beam AND b.rec % 2 = 0 AND b.t < a.t - 0.9
         WHERE a.rec % 2 = 1 GROUP BY ALL),
       f AS (SELECT beam, min(rec) AS first FROM l WHERE rec % 2 = 0 GROUP BY beam)
       SELECT v.beam, rec, coalesce(found, first) AS found FROM v LEFT JOIN f USING (beam)""",
    ("counters",),
)
def record_valid_for(spark, sf):
    rows = table(spark, sf, "counters").select(
        (C("run") % 16).alias("beam"), "rec", (C("us") / F.lit(1e6)).alias("t")
    )
    left = rows.where("rec % 2 = 1")
    right = rows.where("rec % 2 = 0")
    found = lookups.valid_record(left, right, ["beam"], C("t"), C("t"), 3600.0, 0.9)
    return found.select("beam", "rec", C("match.rec").alias("found"))


@query(
    "d14_latest_reading",
    """WITH l AS (SELECT run % 16 AS beam, rec, us, c5 FROM counters)
       SELECT a.beam, a.rec, max(b.rec) AS found, arg_max(b.c5, b.rec) AS reading FROM l a LEFT JOIN l b
         ON a.beam = b.beam AND b.rec % 2 = 0 AND b.us <= a.us
       WHERE a.rec % 2 = 1 GROUP BY ALL""",
    ("counters",),
)
def latest_reading(spark, sf):
    rows = table(spark, sf, "counters").select((C("run") % 16).alias("beam"), "rec", "us", "c5")
    found = lookups.latest_reading(
        rows.where("rec % 2 = 1"), rows.where("rec % 2 = 0"), ["beam"], C("us"), C("us"), 3.6e9
    )
    return found.select("beam", "rec", C("match.rec").alias("found"), C("match.c5").alias("reading"))


@query(
    "d15_interpolated_counter",
    NEAREST
    + """ SELECT run, probe, CAST(trunc((next_total - total)::DOUBLE / (next_orbit - orbit_abs)::DOUBLE * (probe_orbit - orbit_abs)) AS BIGINT)
           + total - base AS counts FROM br""",
    ("crossings",),
)
def interpolated_counter(spark, sf):
    records, found = _nearest(spark, sf)
    first = records.groupBy("run").agg(F.min_by("total", F.struct("orbit_abs", "rec")).alias("base"))
    found = found.join(first, "run", "left")
    counts = lookups.interpolated(C("lower"), C("upper"), C("base"), C("probe_orbit"), "total", "orbit_abs")
    return found.select("run", "probe", counts.alias("counts"))


@query(
    "d16_bracketing_deltas",
    NEAREST
    + """ SELECT run, probe, next_total - total AS counts, (next_orbit - orbit_abs) >> 24 AS periods,
           (next_orbit - orbit_abs) % 16777216 AS orbits FROM br""",
    ("crossings",),
)
def bracketing_deltas(spark, sf):
    _, found = _nearest(spark, sf)
    orbits = C("upper.orbit_abs") - C("lower.orbit_abs")
    return found.select(
        "run",
        "probe",
        (C("upper.total") - C("lower.total")).alias("counts"),
        F.shiftright(orbits, 24).alias("periods"),
        (orbits % PERIOD).alias("orbits"),
    )


@query(
    "d17_tolerance_join",
    """WITH l AS (SELECT run % 16 AS beam, rec, us FROM counters),
       m AS (SELECT a.beam, a.rec, min(b.rec) AS error_rec FROM l a LEFT JOIN l b ON a.beam = b.beam AND b.rec % 2 = 0
           AND b.us BETWEEN a.us - 900000000 AND a.us + 900000000 WHERE a.rec % 2 = 1 GROUP BY ALL)
       SELECT beam, rec, coalesce(error_rec, -1) AS error_rec FROM m""",
    ("counters",),
)
def tolerance_join(spark, sf):
    rows = table(spark, sf, "counters").select((C("run") % 16).alias("beam"), "rec", "us")
    found = lookups.within_tolerance(
        rows.where("rec % 2 = 1"), rows.where("rec % 2 = 0"), ["beam"], C("us"), C("us"), 3.6e9, 900_000_000
    )
    return found.select("beam", "rec", F.coalesce("match.rec", F.lit(-1).cast("bigint")).alias("error_rec"))


_WINDOW = 30_000_000  # orbits, about 45 minutes
_COMBINATIONS = {"any_any": (-1, -1), "set_set": (1, 1), "any_set": (-1, 1), "set_clear": (1, 0)}


@query(
    "d18_interactions_in_window",
    f"""WITH e AS (SELECT run % 16 AS grp, rec, orbit_abs FROM crossings WHERE kind = 'signup'),
       i AS (SELECT run % 16 AS grp, rec AS ir, orbit_abs AS o, int1, int2 FROM crossings WHERE kind <> 'signup')
       SELECT e.grp, e.rec, count(ir) AS any_any, count(*) FILTER (int1 AND int2) AS set_set,
         count(*) FILTER (int2) AS any_set, count(*) FILTER (int1 AND NOT int2) AS set_clear
       FROM e LEFT JOIN i ON e.grp = i.grp AND o BETWEEN orbit_abs - {_WINDOW} AND orbit_abs GROUP BY ALL""",
    ("crossings",),
)
def interactions_in_window(spark, sf):
    rows = table(spark, sf, "crossings").select((C("run") % 16).alias("grp"), "rec", "kind", "orbit_abs", "int1", "int2")
    events = rows.where("kind = 'signup'").select("grp", "rec", "orbit_abs")
    records = rows.where("kind <> 'signup'").select("grp", C("rec").alias("ir"), "orbit_abs", "int1", "int2")
    flags = {
        name: lookups.interaction_wanted(C("int1"), C("int2"), *want) for name, want in _COMBINATIONS.items()
    }
    found = lookups.window_counts(
        events, records, ["grp"], C("orbit_abs") - _WINDOW, C("orbit_abs"), C("orbit_abs"), ["ir"], PERIOD, flags
    )
    return found.select("grp", "rec", *flags)


@query(
    "d18_interaction_records",
    f"""SELECT e.rec, i.rec AS ir FROM crossings e JOIN crossings i ON e.run = i.run AND e.kind = 'signup' AND i.kind <> 'signup'
         AND i.orbit_abs BETWEEN e.orbit_abs - {_WINDOW * 8} AND e.orbit_abs WHERE i.int1 AND NOT i.int2""",
    ("crossings",),
)
def interaction_records(spark, sf):
    rows = table(spark, sf, "crossings").select("run", "rec", "kind", "orbit_abs", "int1", "int2")
    events = rows.where("kind = 'signup'").select("run", "rec", "orbit_abs")
    wanted = lookups.interaction_wanted(C("int1"), C("int2"), 1, 0)
    records = rows.where(wanted & (C("kind") != "signup")).select("run", C("rec").alias("ir"), "orbit_abs")
    placed = lookups.positions(records.withColumnRenamed("orbit_abs", "at"), ["run"], C("at"), ["ir"], PERIOD)
    found = lookups.window_positions(
        events, placed, ["run"], C("orbit_abs") - _WINDOW * 8, C("orbit_abs"), PERIOD
    )
    return lookups.at_positions(found, placed, ["run"]).select("rec", "ir")


@query(
    "d19_signal_with_background",
    """WITH s AS (SELECT o_orderkey % 8 AS file_id, o_orderkey AS signal,
           (row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1) // 12 AS turn FROM orders),
       b AS (SELECT c_custkey % 8 AS file_id, c_custkey AS background,
           row_number() OVER (PARTITION BY c_custkey % 8 ORDER BY c_custkey) - 1 AS turn FROM customer)
       SELECT file_id, signal, background FROM s LEFT JOIN b USING (file_id, turn)""",
)
def signal_with_background(spark, sf):
    signal = base(spark, sf, "orders").select((C("o_orderkey") % 8).alias("file_id"), C("o_orderkey").alias("signal"))
    background = base(spark, sf, "customer").select(
        (C("c_custkey") % 8).alias("file_id"), C("c_custkey").alias("background")
    )
    s = numbered(signal, ["file_id"], F.floor(C("signal") / 65536), ["signal"])
    b = numbered(background, ["file_id"], F.floor(C("background") / 65536), ["background"])
    paired = embedding.pair_up(s, b, ["file_id"], per_background=12)
    return paired.select("file_id", "signal", "background")


@query(
    "d20_unreferenced_objects",
    """SELECT event_idx, obj_id FROM tracks t WHERE NOT EXISTS (SELECT 1 FROM decays d WHERE d.event_idx = t.event_idx
         AND t.obj_id IN (d.pos_id, d.neg_id, d.bach_id))""",
    ("tracks", "decays"),
)
def unreferenced_objects(spark, sf):
    links = F.array("pos_id", "neg_id", "bach_id")
    used = decays(spark, sf).select(*tables.EVENT, F.explode(links).alias("obj_id"))
    return table(spark, sf, "tracks").select(*tables.OBJECT).join(used, tables.OBJECT, "left_anti").drop("file_id")


@query(
    "d21_reference_histogram",
    """WITH h AS (SELECT p_partkey AS hist, p_brand || '_' || p_type AS name, p_brand AS base_name FROM part),
       r AS (SELECT p_brand || '_' || p_type AS name, min(p_size) AS content FROM part WHERE p_type IN ('SMALL', 'ECONOMY') GROUP BY 1
         UNION ALL SELECT p_brand, max(p_size) FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)
       SELECT hist, coalesce(a.content, b.content) AS content, a.name IS NOT NULL AS exact
       FROM h LEFT JOIN r a ON a.name = h.name LEFT JOIN r b ON b.name = h.base_name""",
)
def reference_histogram(spark, sf):
    part = base(spark, sf, "part")
    name = F.concat_ws("_", "p_brand", "p_type")
    hist = part.select(C("p_partkey").alias("hist"), name.alias("name"))
    exact = part.where("p_type IN ('SMALL', 'ECONOMY')").groupBy(name.alias("name")).agg(F.min("p_size").alias("content"))
    plain = part.where("p_partkey % 2 = 0").groupBy(C("p_brand").alias("name")).agg(F.max("p_size").alias("content"))
    found = quality.match_reference(hist, exact.unionByName(plain), F.regexp_extract("name", r"^(.*)_[^_]*$", 1))
    return found.select("hist", "content", "exact")


@query(
    "d22_class_by_prefix",
    """SELECT prefix, max(n_nationkey) AS class_idx FROM (SELECT DISTINCT 'NATION_' || (n_nationkey % 10) AS prefix FROM nation) p
       JOIN nation ON starts_with(n_name, prefix) GROUP BY prefix""",
)
def class_by_prefix(spark, sf):
    nation = base(spark, sf, "nation").select(C("n_nationkey").alias("class_idx"), C("n_name").alias("name"))
    prefixes = [f"NATION_{i}" for i in range(10)]
    return lookups.last_by_prefix(nation, "name", "class_idx", prefixes)


@query("d23_name_to_index", "SELECT event_id, n_nationkey AS class_idx FROM events JOIN nation ON n_name = 'NATION_' || (user_id % 30)")
def name_to_index(spark, sf):
    names = base(spark, sf, "nation").select(C("n_name").alias("name"), C("n_nationkey").alias("class_idx"))
    wanted = base(spark, sf, "events").select("event_id", F.concat(F.lit("NATION_"), (C("user_id") % 30)).alias("name"))
    return wanted.join(names, "name").select("event_id", "class_idx")


BUNCHES_SQL = """bn AS (SELECT user_id % 40 AS fill, (user_id // 40) % 2 AS beam, event_id AS rec, date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 AS t,
    list_transform(range(0, 8), lambda i: 1 + ((event_id * 37 + i * 1213 + user_id) % 40) * 10 + ((user_id // 40) % 2) * 8910) AS bunches FROM events)"""


def bunch_records(spark, sf):
    """Records of both beams, with the bucket numbers of their bunches."""
    buckets = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: 1 + ((C("event_id") * 37 + i * 1213 + C("user_id")) % 40) * 10 + C("beam") * 8910,
    )
    us = table(spark, sf, "readings").select(C("rec").alias("event_id"), "t")
    return (
        base(spark, sf, "events")
        .select("event_id", "user_id")
        .join(us, "event_id")
        .withColumn("beam", F.floor(C("user_id") / 40) % 2)
        .select((C("user_id") % 40).alias("fill"), "beam", C("event_id").alias("rec"), "t", buckets.alias("bunches"))
    )


@query(
    "d24_interacting_bunches",
    f"""WITH {BUNCHES_SQL},
       v AS (SELECT a.fill, a.rec, max(b.rec) AS found FROM bn a LEFT JOIN bn b ON a.fill = b.fill AND b.beam = 1 AND b.t < a.t - 0.9
         WHERE a.beam = 0 GROUP BY ALL),
       f AS (SELECT fill, arg_min(rec, t) AS first FROM bn WHERE beam = 1 GROUP BY fill),
       p AS (SELECT v.fill, v.rec, coalesce(found, first) AS other FROM v LEFT JOIN f USING (fill)),
       x AS (SELECT p.fill, p.rec, list_transform(a.bunches, lambda b: (b // 10 + 344) % 3564) AS s1, list_transform(b.bunches, lambda b: (b // 10 + 3017) % 3564) AS s2
         FROM p JOIN bn a ON a.rec = p.rec LEFT JOIN bn b ON b.rec = p.other)
       SELECT fill, rec, len(list_filter(s1, lambda s: list_contains(s2, s))) AS n_interacting FROM x WHERE s2 IS NOT NULL""",
)
def interacting_bunches(spark, sf):
    rows = bunch_records(spark, sf)
    first, second = rows.where("beam = 0").drop("beam"), rows.where("beam = 1").drop("beam")
    flagged = machine.interacting(first, second, ["fill"], 3600.0)
    return flagged.select("fill", "rec", F.size("interacting").cast("bigint").alias("n_interacting"))


SUBEVENTS_SQL = """se AS (SELECT r_regionkey AS sub, 1000 + 100 * r_regionkey AS n_prim, 4000 + 300 * r_regionkey AS n_all,
    sum(1000 + 100 * r_regionkey) OVER (ORDER BY r_regionkey) - (1000 + 100 * r_regionkey) AS primary_offset,
    sum(1000 + 100 * r_regionkey) OVER () + sum(3000 + 200 * r_regionkey) OVER (ORDER BY r_regionkey) - (3000 + 200 * r_regionkey) AS secondary_offset
  FROM region)"""
LABELS_SQL = """lb AS (SELECT l_orderkey AS event_idx, l_partkey AS part, l_linenumber AS line, l_suppkey AS supp,
    CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END * ((l_partkey % 5) * 10000000 + l_partkey % 4000) AS label FROM lineitem)"""


def labels(spark, sf):
    return base(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS event_idx",
        "l_partkey AS part",
        "l_linenumber AS line",
        "l_suppkey AS supp",
        "CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END * ((l_partkey % 5) * 10000000 + l_partkey % 4000) AS label",
    )


def subevents(spark, sf):
    """Five embedded events with their label offsets."""
    counts = base(spark, sf, "region").selectExpr(
        "0 AS event", "r_regionkey AS sub", "1000 + 100 * r_regionkey AS n_prim", "4000 + 300 * r_regionkey AS n_all"
    )
    return embedding.with_offsets(counts, ["event"]).drop("event")


@query(
    "d25_merged_labels",
    f"""WITH {SUBEVENTS_SQL}, {LABELS_SQL}
       SELECT event_idx, part, line, supp, CAST(sign(label) * (CASE WHEN abs(label) % 10000000 < n_prim THEN abs(label) % 10000000 + primary_offset
         ELSE abs(label) % 10000000 + secondary_offset - n_prim END) AS BIGINT) AS merged
       FROM lb JOIN se ON sub = abs(label) // 10000000""",
)
def merged_labels(spark, sf):
    merged = embedding.merged_labels(labels(spark, sf), subevents(spark, sf), [], "label")
    return merged.select("event_idx", "part", "line", "supp", "merged")


@query(
    "d26_event_to_file",
    """WITH f AS (SELECT p_partkey % 20 AS run, p_partkey AS file, p_size, sum(p_size) OVER (PARTITION BY p_partkey % 20 ORDER BY p_partkey) AS e FROM part)
       SELECT o_orderkey AS event, file, CAST(o_custkey - (e - p_size) AS BIGINT) AS position FROM orders JOIN f ON run = o_orderkey % 20
         AND o_custkey >= e - p_size AND o_custkey < e""",
)
def event_to_file(spark, sf):
    files = base(spark, sf, "part").select(
        (C("p_partkey") % 20).alias("run"), C("p_partkey").alias("file"), C("p_size").cast("bigint").alias("n_events")
    )
    events = base(spark, sf, "orders").select(
        (C("o_orderkey") % 20).alias("run"), C("o_orderkey").alias("event"), C("o_custkey").alias("event_number")
    )
    found = conditions.locate_events(files, events, ["run"], ["file"], F.floor(C("file") / 4096))
    return found.select("event", "file", "position")


_RANGES = "290000 + p_partkey % 50 AS {p}lo, 290000 + p_partkey % 50 + p_size % 11 AS {p}hi"


@query(
    "d27_overlap_and_next_version",
    f"""WITH n AS (SELECT p_partkey AS new_entry, p_type AS l0, p_brand AS l1, {_RANGES.format(p='new_')} FROM part WHERE p_partkey % 2 = 1),
       e AS (SELECT p_partkey AS entry, p_type AS l0, p_brand AS l1, {_RANGES.format(p='')}, p_partkey % 3 AS version, p_partkey % 5 AS sub_version
         FROM part WHERE p_partkey % 2 = 0),
       o AS (SELECT new_entry, min(entry) AS clash, max(version * 100 + sub_version) AS best
         FROM n JOIN e USING (l0, l1) WHERE lo <= new_hi AND new_lo <= hi GROUP BY new_entry)
       SELECT new_entry, clash, coalesce(best // 100, 0) AS next_version, coalesce(best % 100, -1) + 1 AS next_sub_version
       FROM n LEFT JOIN o USING (new_entry)""",
)
def overlap_and_next_version(spark, sf):
    part = base(spark, sf, "part")
    path = ["p_type AS l0", "p_brand AS l1"]
    new = part.where("p_partkey % 2 = 1").selectExpr(
        "p_partkey AS new_entry", *path, *[e.strip() for e in _RANGES.format(p="new_").split(",")]
    )
    existing = part.where("p_partkey % 2 = 0").selectExpr(
        "p_partkey AS entry",
        *path,
        *[e.strip() for e in _RANGES.format(p="").split(",")],
        "p_partkey % 3 AS version",
        "p_partkey % 5 AS sub_version",
    )
    clash = conditions.overlapping(new, existing, PATH, ["new_entry"], best=(C("entry"), -C("entry"))).withColumnRenamed("best", "clash")
    numbered_new = conditions.next_version(new, existing, PATH, ["new_entry"])
    return numbered_new.join(clash, "new_entry", "left").select(
        "new_entry", "clash", "next_version", "next_sub_version"
    )


@query(
    "d28_run_to_period",
    """SELECT event_idx, run, n_name AS period_name FROM collisions JOIN nation
         ON run BETWEEN 290000 + n_nationkey * 3 AND 290002 + n_nationkey * 3""",
    ("collisions",),
)
def run_to_period(spark, sf):
    periods = base(spark, sf, "nation").select(
        C("n_name").alias("period_name"),
        (290000 + C("n_nationkey") * 3).cast("bigint").alias("first_run"),
        (290002 + C("n_nationkey") * 3).cast("bigint").alias("last_run"),
    )
    runs = table(spark, sf, "collisions").select("event_idx", "run")
    return conditions.period_of_run(runs, periods).select("event_idx", "run", "period_name")


@query(
    "d29_compare_payloads",
    """WITH a AS (SELECT p_partkey AS entry, p_name AS payload FROM part WHERE p_partkey % 17 <> 0),
       b AS (SELECT p_partkey AS entry, CASE WHEN p_partkey % 10 = 0 THEN upper(p_name) WHEN p_partkey % 10 = 1 THEN p_name || 'x' ELSE p_name END AS payload
         FROM part WHERE p_partkey % 19 <> 0)
       SELECT coalesce(a.entry, b.entry) AS entry, CASE WHEN b.entry IS NULL THEN 'only_first' WHEN a.entry IS NULL THEN 'only_second'
         WHEN strlen(a.payload) <> strlen(b.payload) THEN 'size' WHEN a.payload <> b.payload THEN 'content' ELSE 'same' END AS verdict
       FROM a FULL JOIN b ON a.entry = b.entry""",
)
def compare_payloads(spark, sf):
    part = base(spark, sf, "part")
    first = part.where("p_partkey % 17 <> 0").selectExpr("p_partkey AS entry", "p_name AS payload")
    second = part.where("p_partkey % 19 <> 0").selectExpr(
        "p_partkey AS entry",
        "CASE WHEN p_partkey % 10 = 0 THEN upper(p_name) WHEN p_partkey % 10 = 1 THEN concat(p_name, 'x')"
        " ELSE p_name END AS payload",
    )
    return conditions.compare_payloads(first, second, ["entry"])
