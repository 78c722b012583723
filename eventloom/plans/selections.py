"""Event and candidate selections composed of simpler ones; the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import decays as kin
from eventloom.functions import status, tracks, triggers
from eventloom.operators import cleaning, histograms, tables
from eventloom.plans.derived import decays
from eventloom.plans.domain import table
from eventloom.plans.registry import query

C = F.col
EVENT = tables.EVENT


@query(
    "flagship_pt_spectrum",
    """WITH s AS (SELECT c.n_contrib // 20 AS event_class, abs(1 / t.signed1pt) AS pt
         FROM tracks t JOIN tracks_extra e USING (file_id, event_idx, obj_id) JOIN collisions c USING (file_id, event_idx)
         WHERE (e.flags & 64) <> 0 AND abs(-ln(tan((pi() / 2 - atan(t.tgl)) / 2))) < 0.8 AND t.signed1pt <> 0),
       h AS (SELECT event_class, CAST(least(floor(pt / 20.0 * 50), 49) AS BIGINT) AS bin, count(*) AS content FROM s WHERE pt >= 0 AND pt <= 20 GROUP BY ALL)
       SELECT CAST(g.event_class AS INT) AS event_class, g.bin, coalesce(content, 0) AS content
       FROM (SELECT DISTINCT event_class, b.bin FROM h, range(50) b(bin)) g LEFT JOIN h ON h.event_class = g.event_class AND h.bin = g.bin""",
    ("tracks", "tracks_extra", "collisions"),
)
def pt_spectrum(spark, sf):
    """Refitted central tracks of each collision class, in bins of transverse momentum."""
    extra = table(spark, sf, "tracks_extra").where(triggers.any_bit(C("flags"), status.TPC_REFIT)).select(*tables.OBJECT)
    main = (
        table(spark, sf, "tracks")
        .where((F.abs(tracks.eta(C("tgl"))) < 0.8) & (C("signed1pt") != 0))
        .select(*tables.OBJECT, tracks.pt(C("signed1pt")).alias("pt"))
    )
    collisions = table(spark, sf, "collisions").select(
        *EVENT, F.floor(C("n_contrib") / 20).cast("int").alias("event_class")
    )
    selected = main.join(extra, tables.OBJECT).join(collisions, EVENT)
    return histograms.histogram(selected, C("pt"), 50, 0.0, 20.0, keys=["event_class"])


_SPOT = {"x": 0.01, "y": -0.02, "z": 0.5}
_SPOT_SQL = "CASE WHEN run % 4 = 0 THEN 0.00005::DOUBLE ELSE 0.0004::DOUBLE END AS sxy, CASE WHEN run % 5 = 0 THEN 0.0 ELSE 25.0 END::DOUBLE AS sz"


def _pile_up_sql(contributors: str) -> str:
    return f"""WITH c AS (SELECT *, {_SPOT_SQL} FROM collisions),
      j AS (SELECT c.event_idx, c.n_contrib, coalesce(v.v_contrib >= {contributors} AND abs(v.vz - c.z) > 0.8
          AND abs(v.vz - 0.5) < CASE WHEN sz < 0.0001 THEN 99999 ELSE 5 * sqrt(sz) END
          AND abs(v.vx - 0.01) < CASE WHEN sxy < 0.0001 THEN 99999 ELSE 2 * sqrt(v.v_xx + sxy) END
          AND abs(v.vy + 0.02) < CASE WHEN sxy < 0.0001 THEN 99999 ELSE 2 * sqrt(v.v_yy + sxy) END
          AND abs(v.vz - c.z) > 3 * sqrt(c.cov_zz + v.v_zz), false) AS pile
        FROM c LEFT JOIN vertices v USING (file_id, event_idx))
      SELECT event_idx, bool_or(pile AND n_contrib >= 1) AS pile_up FROM j GROUP BY event_idx"""


def _pile_up(spark, sf, min_contributors):
    collisions = table(spark, sf, "collisions").select(
        *EVENT,
        "n_contrib",
        "z",
        "cov_zz",
        F.when(C("run") % 4 == 0, 5e-5).otherwise(4e-4).alias("sxy"),
        F.when(C("run") % 5 == 0, 0.0).otherwise(25.0).alias("sz"),
    )
    vertex = {a: C(f"v{a}") for a in "xyz"} | {a: C(f"v_{a}") for a in ("xx", "yy", "zz")}
    spot = {a: F.lit(v) for a, v in _SPOT.items()} | {"xx": C("sxy"), "yy": C("sxy"), "zz": C("sz")}
    test = cleaning.is_pile_up(
        C("z"), C("cov_zz"), vertex | {"contributors": C("v_contrib")}, spot, min_contributors
    )
    found = (
        table(spark, sf, "vertices")
        .where("v_contrib >= 3")
        .join(collisions.where("n_contrib >= 1"), EVENT)
        .where(test)
        .select(*EVENT)
        .distinct()
        .withColumn("pile_up", F.lit(True))
    )
    return collisions.join(found, EVENT, "left").select(
        "event_idx", F.coalesce("pile_up", F.lit(False)).alias("pile_up")
    )


@query("k01_pile_up_flag", _pile_up_sql("5"), ("collisions", "vertices"))
def pile_up_flag(spark, sf):
    return _pile_up(spark, sf, cleaning.MIN_CONTRIBUTORS)


@query(
    "k02_pile_up_by_multiplicity",
    _pile_up_sql("CASE WHEN c.n_contrib < 20 THEN 3 WHEN c.n_contrib < 50 THEN 4 ELSE 5 END"),
    ("collisions", "vertices"),
)
def pile_up_by_multiplicity(spark, sf):
    return _pile_up(spark, sf, cleaning.contributors_by_multiplicity(C("n_contrib")))


_HYPOTHESES = [
    {"m0": kin.MASSES["pion"], "m1": kin.MASSES["pion"], "mass": kin.MASSES["k0s"], "sigma": 0.1, "sigmas": 5.0, "c0": 1.0, "c1": 0.2, "add": 0.05},
    {"m0": kin.MASSES["proton"], "m1": kin.MASSES["pion"], "mass": kin.MASSES["lambda"], "sigma": 0.08, "sigmas": 5.0, "c0": 1.0, "c1": 0.1, "add": 0.02},
]
_PAIR_MASS = """sqrt(greatest({m0} ** 2 + {m1} ** 2 + 2 * (sqrt({m0} ** 2 + ppx * ppx + ppy * ppy + ppz * ppz)
  * sqrt({m1} ** 2 + npx * npx + npy * npy + npz * npz) - ppx * npx - ppy * npy - ppz * npz), 0))"""
_WINDOWS = " OR ".join(
    f"abs({_PAIR_MASS.format(**h)} - {h['mass']}) < {h['sigmas']} * (5.00668 / 5.0) * {h['sigma']} * ({h['c0']} + {h['c1']} * pt) + {h['add']}"
    for h in _HYPOTHESES
)
PAIRS_SQL = """d AS (SELECT *, event_idx % 2 = 0 AS on_fly, event_idx % 5 = 0 AS used, ppx + npx AS vx, ppy + npy AS vy, ppz + npz AS vz FROM decays),
  m AS (SELECT *, sqrt(vx * vx + vy * vy) AS pt, sqrt(vx * vx + vy * vy + vz * vz) AS p FROM d)"""


def pairs(spark, sf):
    return decays(spark, sf).withColumns({"on_fly": C("event_idx") % 2 == 0, "used": C("event_idx") % 5 == 0})


@query(
    "k03_clean_pairs",
    f"""WITH {PAIRS_SQL}, f AS (SELECT *, abs(0.5 * ln((p + vz) / (p - vz + 1e-13))) > 0.8 AS wide, ({_WINDOWS}) AS in_window FROM m)
       SELECT event_idx, pos_id, neg_id FROM f
       WHERE NOT (CASE WHEN on_fly THEN NOT used AND (wide OR NOT in_window) ELSE wide AND NOT used END) OR event_idx % 3 = 0""",
    ("decays",),
)
def clean_pairs(spark, sf):
    df = pairs(spark, sf)
    cascades = df.where("event_idx % 3 = 0").select(*EVENT, "pos_id", "neg_id")
    kept = cleaning.clean_pairs(df, cascades, EVENT, _HYPOTHESES, 0.8, F.lit(5.0))
    return kept.select("event_idx", "pos_id", "neg_id")


_KEEP = 0x8


def _candidates(spark, sf):
    main = table(spark, sf, "tracks").select(*tables.OBJECT, "x", "z", "tgl")
    extra = table(spark, sf, "tracks_extra").select(*tables.OBJECT, "flags", "dz", "cov_zz")
    vertex = table(spark, sf, "collisions").select(*EVENT, C("z").alias("vertex_z"))
    df = main.join(extra, tables.OBJECT).join(vertex, EVENT).withColumn("spared", C("obj_id") % 11 == 0)
    used = decays(spark, sf).where("event_idx % 3 = 0").select(
        *EVENT, F.explode(F.array("pos_id", "neg_id", "bach_id")).alias("obj_id")
    )
    return cleaning.removal_candidates(df, used, EVENT, _KEEP, 1.0)


def _kinks(spark, sf):
    df = decays(spark, sf)
    first = df.where("event_idx % 2 = 0").select(*EVENT, C("pos_id").alias("mother_id"), C("neg_id").alias("daughter_id"))
    second = df.where("event_idx % 5 < 3 AND neg_id <> bach_id").select(
        *EVENT, C("neg_id").alias("mother_id"), C("bach_id").alias("daughter_id")
    )
    return first.unionByName(second)


CANDIDATES_SQL = """cd AS (SELECT t.event_idx, t.obj_id FROM tracks t JOIN tracks_extra e USING (file_id, event_idx, obj_id) JOIN collisions c USING (file_id, event_idx)
    WHERE (e.flags & 8) = 0 AND abs(CASE WHEN e.cov_zz < 1e-9 THEN t.z - t.tgl * t.x - c.z ELSE e.dz END) >= 1.0 AND t.obj_id % 11 <> 0
      AND NOT EXISTS (SELECT 1 FROM decays d WHERE d.event_idx = t.event_idx AND d.event_idx % 3 = 0 AND t.obj_id IN (d.pos_id, d.neg_id, d.bach_id))),
  kk AS (SELECT event_idx, pos_id AS a, neg_id AS b FROM decays WHERE event_idx % 2 = 0
    UNION ALL SELECT event_idx, neg_id, bach_id FROM decays WHERE event_idx % 5 < 3 AND neg_id <> bach_id),
  lg AS (SELECT event_idx, a, b FROM kk UNION ALL SELECT event_idx, b, a FROM kk),
  sp AS (SELECT lg.event_idx, lg.a FROM lg WHERE NOT EXISTS (SELECT 1 FROM cd WHERE cd.event_idx = lg.event_idx AND cd.obj_id = lg.b)
    UNION SELECT lg.event_idx, lg.a FROM lg JOIN sp ON sp.event_idx = lg.event_idx AND sp.a = lg.b),
  rm AS (SELECT * FROM cd WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.event_idx = cd.event_idx AND sp.a = cd.obj_id))"""
_TABLES = ("tracks", "tracks_extra", "collisions", "decays")


@query("k04_track_cleaning", f"WITH RECURSIVE {CANDIDATES_SQL} SELECT event_idx, obj_id FROM rm", _TABLES)
def track_cleaning(spark, sf):
    removed = cleaning.spare_kinks(_candidates(spark, sf), _kinks(spark, sf), EVENT)
    return removed.select("event_idx", "obj_id")


@query(
    "k05_reindexed_references",
    f"""WITH RECURSIVE {CANDIDATES_SQL},
       kept AS (SELECT t.event_idx, t.obj_id, row_number() OVER (PARTITION BY t.event_idx ORDER BY t.obj_id) - 1 AS new_idx FROM tracks t
         WHERE NOT EXISTS (SELECT 1 FROM cd WHERE cd.event_idx = t.event_idx AND cd.obj_id = t.obj_id))
       SELECT d.event_idx, p.new_idx AS pos_idx, n.new_idx AS neg_idx FROM decays d LEFT JOIN kept p ON p.event_idx = d.event_idx AND p.obj_id = d.pos_id
         LEFT JOIN kept n ON n.event_idx = d.event_idx AND n.obj_id = d.neg_id""",
    _TABLES,
)
def reindexed_references(spark, sf):
    kept = table(spark, sf, "tracks").select(*tables.OBJECT).join(_candidates(spark, sf), tables.OBJECT, "left_anti")
    index = cleaning.reindexed(kept, EVENT, "obj_id", F.shiftright("obj_id", 57))
    links = decays(spark, sf).select(*EVENT, C("pos_id").alias("pos_idx"), C("neg_id").alias("neg_idx"))
    for link in ("pos_idx", "neg_idx"):
        links = cleaning.relabel(links, index, EVENT, link)
    return links.drop("file_id")


def found_vertices(spark, sf):
    """Vertex candidates of an event, close enough in z that some are split ones."""
    return table(spark, sf, "vertices").select(
        *EVENT,
        "obj_id",
        C("vx").alias("x"),
        C("vy").alias("y"),
        (C("vz") / 10).alias("z"),
        (C("v_xx") * 10).alias("cov_xx"),
        (C("v_xy") * 10).alias("cov_xy"),
        (C("v_yy") * 10).alias("cov_yy"),
        (C("v_zz") * 10).alias("cov_zz"),
        C("v_contrib").alias("n_indices"),
        F.when(C("v_bc") < 0, cleaning.UNKNOWN_BUNCH).otherwise(C("v_bc")).alias("bunch"),
    )


_VERTICES = """v AS (SELECT event_idx, obj_id, vx AS x, vy AS y, vz / 10 AS z, v_xx * 10 AS xx, v_xy * 10 AS xy, v_yy * 10 AS yy,
         v_zz * 10 AS zz, v_contrib AS n, CASE WHEN v_bc < 0 THEN -100 ELSE v_bc END AS bunch,
         row_number() OVER (PARTITION BY event_idx ORDER BY v_contrib DESC, obj_id) AS i FROM vertices),
       p AS (SELECT a.event_idx, a.i, b.i AS j, b.bunch, b.n * (CASE WHEN s > 0 THEN sqrt(s) ELSE -1 END) AS d FROM v a JOIN v b
         ON a.event_idx = b.event_idx AND a.i < b.i, LATERAL (SELECT
           ((a.yy + b.yy) * (a.x - b.x) ** 2 + (a.xx + b.xx) * (a.y - b.y) ** 2 - 2 * (a.xy + b.xy) * (a.x - b.x) * (a.y - b.y))
           / ((a.xx + b.xx) * (a.yy + b.yy) - (a.xy + b.xy) ** 2) + (a.z - b.z) ** 2 / (a.zz + b.zz) AS s)),
       c AS (SELECT event_idx, i, list({'j': j, 'b': bunch} ORDER BY d, j) FILTER (WHERE d < 10) AS near FROM p GROUP BY ALL),
       e AS (SELECT event_idx, list(bunch ORDER BY i) AS bunches, list(coalesce(near, []) ORDER BY i) AS near, max(i) AS n
         FROM v LEFT JOIN c USING (event_idx, i) GROUP BY event_idx),
       s AS (SELECT event_idx, bunches, near, n, 0 AS i, CAST([] AS BIGINT[]) AS gone, CAST([] AS INTEGER[]) AS taken FROM e
         UNION ALL
         SELECT event_idx, bunches, near, n, i + 1, CASE WHEN dead THEN gone ELSE list_concat(gone,
             list_transform(list_filter(rest, lambda r: r.b = own OR r.b = -100), lambda r: r.j)) END, list_append(taken, own)
         FROM (SELECT *, CASE WHEN dead OR bunches[i + 1] <> -100 THEN bunches[i + 1]
             ELSE coalesce(list_filter(rest, lambda r: r.b <> -100)[1].b, -100) END AS own
           FROM (SELECT *, list_contains(gone, i + 1) AS dead, list_filter(near[i + 1], lambda r: NOT list_contains(gone, r.j)) AS rest
             FROM s WHERE i < n))),
       m AS (SELECT v.*, taken[v.i] AS got FROM v JOIN s USING (event_idx) WHERE s.i = s.n AND NOT list_contains(gone, v.i)),
       b AS (SELECT event_idx, arg_max(obj_id, (got = 0, n, -obj_id)) AS best FROM m WHERE got IN (0, -100) GROUP BY event_idx)"""


@query(
    "k06_split_vertex_merge",
    f"""WITH RECURSIVE {_VERTICES}
       SELECT event_idx, obj_id, n AS n_indices, CAST(got AS INT) AS bunch, coalesce(obj_id = best, false) AS is_primary
       FROM m LEFT JOIN b USING (event_idx)""",
    ("vertices",),
)
def split_vertex_merge(spark, sf):
    merged = cleaning.merge_split_vertices(found_vertices(spark, sf), EVENT)
    return cleaning.primary_vertex(merged, EVENT).select("event_idx", "obj_id", "n_indices", "bunch", "is_primary")
