"""Monte-Carlo ancestry."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import ancestry, embedding
from eventloom.operators.ordered import numbered
from eventloom.plans.domain import base, table
from eventloom.plans.joins import LABELS_SQL, labels
from eventloom.plans.registry import query

C = F.col
KEYS = ["file_id", "event_idx"]
T = ("particles",)

# a third of an event's particles come from the generator
EVENTS_SQL = "ev AS (SELECT file_id, event_idx, CAST(floor((max(idx) + 1) / 3) AS BIGINT) AS n_primary FROM particles GROUP BY 1, 2)"
ROOTS_SQL = """rt AS (SELECT event_idx, idx, idx AS cur, mother FROM particles
    UNION ALL SELECT rt.event_idx, rt.idx, p.idx, p.mother FROM rt JOIN particles p ON p.event_idx = rt.event_idx AND p.idx = rt.mother),
  root AS (SELECT event_idx, idx, cur AS root FROM rt WHERE mother < 0)"""


def particles(spark, sf):
    return table(spark, sf, "particles")


def mc_events(spark, sf):
    count = F.floor((F.max("idx") + 1) / 3).alias("n_primary")
    return particles(spark, sf).groupBy(*KEYS).agg(count)


def with_daughters(spark, sf):
    df = particles(spark, sf)
    first = df.where("mother >= 0").groupBy(*KEYS, C("mother").alias("idx")).agg(F.min("idx").alias("first_daughter"))
    return df.join(first, [*KEYS, "idx"], "left").withColumn(
        "first_daughter", F.coalesce("first_daughter", F.lit(-1).cast("bigint"))
    )


@query("n01_root_ancestor", f"WITH RECURSIVE {ROOTS_SQL} SELECT event_idx, idx, root FROM root", T)
def root_ancestor(spark, sf):
    return ancestry.roots(particles(spark, sf), KEYS).select("event_idx", "idx", "root")


_STABLE = ", ".join(str(s) for s in ancestry.STABLE)
_DIGIT = "CAST(substr(CAST(abs({}) AS VARCHAR), 1, 1) AS INT)"
PRIMARY_SQL = f"""{EVENTS_SQL},
  up AS (SELECT p.event_idx, p.idx, p.idx AS cur, p.mother AS nxt, n_primary FROM particles p JOIN ev USING (event_idx)
    UNION ALL SELECT up.event_idx, up.idx, p.idx, p.mother, n_primary FROM up JOIN particles p ON p.event_idx = up.event_idx AND p.idx = up.nxt WHERE up.cur >= n_primary),
  gn AS (SELECT event_idx, idx, cur FROM up WHERE cur < n_primary),
  fd AS (SELECT event_idx, mother AS idx, min(idx) AS d FROM particles WHERE mother >= 0 GROUP BY 1, 2),
  j AS (SELECT p.*, n_primary, m.pdg AS mp, g.pdg AS gp, dd.pdg AS dp FROM particles p JOIN ev USING (event_idx)
    LEFT JOIN particles m ON m.event_idx = p.event_idx AND m.idx = p.mother
    LEFT JOIN gn ON gn.event_idx = p.event_idx AND gn.idx = p.idx LEFT JOIN particles g ON g.event_idx = p.event_idx AND g.idx = gn.cur
    LEFT JOIN fd ON fd.event_idx = p.event_idx AND fd.idx = p.idx LEFT JOIN particles dd ON dd.event_idx = p.event_idx AND dd.idx = fd.d),
  pp AS (SELECT *, NOT (status > 1 AND NOT (idx < n_primary AND abs(pdg) = 130)) AND (abs(pdg) > 1000000000 OR abs(pdg) IN ({_STABLE}))
      AND CASE WHEN idx < n_primary THEN NOT coalesce(abs(mp) = 130, false) AND NOT (abs(pdg) = 22 AND coalesce(dp = 22, false))
        ELSE coalesce((abs(mp) IN (3212, 111) AND mother < n_primary) OR ({_DIGIT.format('mp')} >= 4 AND (mother < n_primary OR {_DIGIT.format('gp')} >= 4)), false) END AS prim FROM j),
  wk AS (SELECT *, coalesce(NOT prim AND mother >= 0 AND process = 4 AND ({_DIGIT.format('mp')} = 3 OR abs(mp) IN (211, 13)
      OR (abs(mp) > 1000000000 AND (mp // 10000000) % 10 <> 0)), false) AS weak FROM pp)"""


def _origin(spark, sf):
    return ancestry.physical_primaries(with_daughters(spark, sf), mc_events(spark, sf), KEYS)


@query("n02_physical_primary", f"WITH RECURSIVE {PRIMARY_SQL} SELECT event_idx, idx, prim AS is_primary FROM pp", T)
def physical_primary(spark, sf):
    return _origin(spark, sf).select("event_idx", "idx", "is_primary")


@query("n03_from_weak_decay", f"WITH RECURSIVE {PRIMARY_SQL} SELECT event_idx, idx, weak FROM wk", T)
def from_weak_decay(spark, sf):
    df = _origin(spark, sf)
    return df.select("event_idx", "idx", ancestry.from_weak_decay(df).alias("weak"))


@query(
    "n04_from_material",
    f"WITH RECURSIVE {PRIMARY_SQL} SELECT event_idx, idx, NOT prim AND NOT weak AND mother >= 0 AS material FROM wk",
    T,
)
def from_material(spark, sf):
    df = _origin(spark, sf)
    return df.select("event_idx", "idx", ancestry.from_material(df).alias("material"))


@query(
    "n05_generator_of_particle",
    f"""WITH RECURSIVE {EVENTS_SQL}, {ROOTS_SQL},
       gn AS (SELECT n_regionkey AS config, n_name AS name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos FROM nation),
       ge AS (SELECT event_idx, n_primary, pos, name, 1 + pos AS np,
         sum(1 + pos) OVER (PARTITION BY event_idx ORDER BY pos DESC) AS taken FROM ev JOIN gn ON config = event_idx % 5),
       rg AS (SELECT event_idx, pos, name, CASE WHEN pos = 0 THEN 0 ELSE greatest(n_primary - taken, 0) END AS lo, n_primary - taken + np - 1 AS hi FROM ge)
       SELECT root.event_idx, idx, pos AS generator, name FROM root LEFT JOIN rg ON rg.event_idx = root.event_idx AND root BETWEEN lo AND hi""",
    T,
)
def generator_of_particle(spark, sf):
    events = mc_events(spark, sf)
    listed = base(spark, sf, "nation").select(C("n_regionkey").alias("config"), C("n_name").alias("name"), "n_nationkey")
    listed = numbered(listed, ["config"], F.lit(0), ["n_nationkey"])
    listed = listed.select("config", "name", (C("rank") - 1).alias("pos"), C("rank").alias("n_produced"))
    generators = events.select(*KEYS, (C("event_idx") % 5).alias("config")).join(listed, "config").drop("config")
    found = ancestry.generators_of(particles(spark, sf), generators, events, KEYS)
    return found.select("event_idx", "idx", "generator", "name")


@query(
    "n06_background_flag",
    f"WITH {LABELS_SQL} SELECT event_idx, part, line, supp, abs(label) >= 10000000 AS background FROM lb",
)
def background_flag(spark, sf):
    return labels(spark, sf).select(
        "event_idx", "part", "line", "supp", embedding.from_background(C("label")).alias("background")
    )


_QUARK = """CASE WHEN abs(mp) <= 10 THEN abs(mp) WHEN abs(mp) // 100 <= 10 THEN abs(mp) // 100 WHEN abs(mp) // 1000 > 10 THEN abs(mp) // 10000
  ELSE abs(mp) // 1000 END"""
PRUNED_SQL = f"""{EVENTS_SQL},
  j AS (SELECT p.*, n_primary, m.pdg AS mp FROM particles p JOIN ev USING (event_idx) LEFT JOIN particles m ON m.event_idx = p.event_idx AND m.idx = p.mother),
  ch AS (SELECT event_idx, idx, idx AS cur, mother AS nxt, process, n_primary FROM j
    UNION ALL SELECT ch.event_idx, ch.idx, j.idx, j.mother, j.process, j.n_primary FROM ch JOIN j ON j.event_idx = ch.event_idx AND j.idx = ch.nxt WHERE ch.cur >= ch.n_primary AND ch.process = 4),
  ce AS (SELECT event_idx, idx, min(cur) AS chain_end FROM ch GROUP BY 1, 2),
  fm AS (SELECT event_idx, idx, mother FROM particles WHERE idx % 11 = 5 UNION SELECT p.event_idx, p.idx, p.mother FROM fm JOIN particles p ON p.event_idx = fm.event_idx AND p.idx = fm.mother),
  kp AS (SELECT j.*, row_number() OVER (PARTITION BY j.event_idx ORDER BY j.idx) - 1 AS new_idx FROM j JOIN ce USING (event_idx, idx)
    WHERE idx < n_primary OR EXISTS (SELECT 1 FROM fm WHERE fm.event_idx = j.event_idx AND fm.idx = j.idx)
      OR (mother >= 0 AND mother < n_primary AND ((sqrt(vx * vx + vy * vy) < 2.0 AND abs(vz) < 20) OR {_QUARK} >= 4 OR process = 5))
      OR (process = 4 AND mother >= 0 AND chain_end < n_primary))"""
_REMAP = """SELECT k.event_idx, k.idx, k.new_idx, coalesce(m.new_idx, -1) AS new_mother, coalesce(s.a, -1) AS new_first, coalesce(s.b, -1) AS new_last
  FROM kp k LEFT JOIN kp m ON m.event_idx = k.event_idx AND m.idx = k.mother
  LEFT JOIN (SELECT c.event_idx, c.mother, min(c.new_idx) AS a, max(c.new_idx) AS b FROM kp c GROUP BY 1, 2) s ON s.event_idx = k.event_idx AND s.mother = k.idx"""
_NEW = ("event_idx", "idx", "new_idx", "new_mother", "new_first", "new_last")


@query("n07_pruned_forest", f"WITH RECURSIVE {PRUNED_SQL} {_REMAP}", T)
def pruned_forest(spark, sf):
    df = particles(spark, sf)
    return ancestry.pruned(df, mc_events(spark, sf), df.where("idx % 11 = 5"), KEYS, 2.0, 20.0).select(*_NEW)


# the same forest under numbers that scatter a mother's daughters
_SCATTER_SQL = f"""{EVENTS_SQL},
  sc AS (SELECT p.event_idx, p.idx, CASE WHEN p.idx < n_primary THEN p.mother ELSE (p.idx * 7) % n_primary END AS mother, n_primary FROM particles p JOIN ev USING (event_idx)),
  kp AS (SELECT *, row_number() OVER (PARTITION BY event_idx ORDER BY CASE WHEN idx < n_primary THEN -1 ELSE mother END, idx) - 1 AS new_idx FROM sc)"""


@query("n08_children_together", f"WITH {_SCATTER_SQL} {_REMAP}", T)
def children_together(spark, sf):
    events = mc_events(spark, sf)
    scattered = (
        particles(spark, sf)
        .join(events, KEYS)
        .withColumn("mother", F.when(C("idx") < C("n_primary"), C("mother")).otherwise((C("idx") * 7) % C("n_primary")))
        .drop("n_primary")
    )
    return ancestry.children_together(scattered, events, KEYS).select(*_NEW)


_DETECTORS = ("FRAME", "ITS", "TPC", "TRD", "TOF", "FWD", "MUON")
_REFS_SQL = " UNION ALL ".join(
    f"SELECT o_custkey % 10 AS event_idx, CAST(floor(o_custkey / 10) AS BIGINT) AS idx, '{d}' AS detector, o_orderkey AS ref FROM orders WHERE o_orderkey % 7 = {i}"
    for i, d in enumerate(_DETECTORS)
)


@query(
    "n09_track_references",
    f"""WITH RECURSIVE {PRIMARY_SQL}, rf AS ({_REFS_SQL}),
       en AS (SELECT j.event_idx, j.idx, row_number() OVER (PARTITION BY j.event_idx ORDER BY CASE WHEN j.idx >= n_primary THEN 0 ELSE 1 END,
           CASE WHEN j.idx >= n_primary THEN -gn.cur ELSE 0 END, j.idx) - 1 AS entry FROM j JOIN gn USING (event_idx, idx))
       SELECT en.event_idx, en.idx, entry, count(ref) OVER (PARTITION BY en.event_idx, en.idx) AS n_refs, detector, ref FROM en LEFT JOIN rf USING (event_idx, idx)""",
    T,
)
def track_references(spark, sf):
    hits = base(spark, sf, "orders").select(
        (C("o_custkey") % 2).alias("file_id"),
        (C("o_custkey") % 10).alias("event_idx"),
        F.floor(C("o_custkey") / 10).alias("label"),
        C("o_orderkey").alias("ref"),
    )
    per_detector = [(d, hits.where(C("ref") % 7 == i)) for i, d in enumerate(_DETECTORS)]
    events = mc_events(spark, sf)
    df = particles(spark, sf).join(events, KEYS)
    df = ancestry.first_ancestor(df, KEYS, C("idx") < C("n_primary"), "root_primary").drop("n_primary")
    return ancestry.track_references(per_detector, df, events, KEYS).drop("file_id")
