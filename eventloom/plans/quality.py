"""Quality assurance."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from eventloom.functions import status, tracks
from eventloom.functions.triggers import any_bit
from eventloom.operators import histograms, quality
from eventloom.operators.tables import OBJECT
from eventloom.plans.domain import base, table
from eventloom.plans.filters import EVENT_CLASSES, with_classes
from eventloom.plans.registry import query, r6

C = F.col

GROUPS = {"kMinBias": ["NATION_1", "NATION_6", "NATION_2"], "kMuon": ["NATION_11", "NATION_3", "NATION_14"]}
_GROUPS_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT event_idx, '{alias}' AS trigger_group FROM ec WHERE fired AND name IN ({', '.join(repr(n) for n in names)})"
    for alias, names in GROUPS.items()
)
GROUPED_SQL = f"{EVENT_CLASSES}, gr AS ({_GROUPS_SQL} UNION ALL SELECT event_idx, '' FROM collisions)"
TABLES = ("collisions", "trigger_classes")


@query(
    "p01_histograms_per_trigger_group",
    f"""WITH {GROUPED_SQL},
       h AS (SELECT trigger_group, CAST(least(floor((z + 10) / 20 * 40), 39) AS BIGINT) AS bin, count(*) AS content
         FROM gr JOIN collisions USING (event_idx) WHERE z >= -10 AND z <= 10 GROUP BY ALL)
       SELECT g.trigger_group, g.bin, coalesce(content, 0) AS content
       FROM (SELECT DISTINCT trigger_group, b.bin FROM h, range(40) b(bin)) g LEFT JOIN h ON h.trigger_group = g.trigger_group AND h.bin = g.bin""",
    TABLES,
)
def histograms_per_trigger_group(spark, sf):
    groups = quality.matching_groups(C("fired"), GROUPS)
    return quality.grouped_histogram(with_classes(spark, sf, "z"), C("z"), 40, -10.0, 10.0, groups)


@query(
    "p02_event_counts",
    f"""WITH {GROUPED_SQL} SELECT event_type AS species, run % 4 AS cycle, trigger_group, count(*) AS n_events
       FROM gr JOIN collisions USING (event_idx) GROUP BY ALL""",
    TABLES,
)
def event_counts(spark, sf):
    df = with_classes(spark, sf, "run", "event_type").withColumns(
        {"species": C("event_type"), "cycle": C("run") % 4}
    )
    return quality.event_counts(df, ["species", "cycle"], quality.matching_groups(C("fired"), GROUPS))


_HIST_SQL = """bn AS (SELECT its_ncls AS species, tpc_ncls % 4 AS hist, CAST(least(floor(tpc_signal / 200 * 50), 49) AS BIGINT) AS bin,
    count(*) FILTER (obj_id % 3 = 0) AS a, count(*) FILTER (obj_id % 3 <> 0) AS b FROM tracks_extra WHERE tpc_signal <= 200 GROUP BY ALL)"""


def _pairs(spark, sf):
    """A third of the tracks as data, the rest as reference, per species and histogram."""
    df = table(spark, sf, "tracks_extra").withColumns({"species": C("its_ncls"), "hist": C("tpc_ncls") % 4})
    keys = ["species", "hist"]
    data = histograms.histogram(df.where("obj_id % 3 = 0"), C("tpc_signal"), 50, 0.0, 200.0, keys=keys)
    reference = histograms.histogram(df.where("obj_id % 3 <> 0"), C("tpc_signal"), 50, 0.0, 200.0, keys=keys)
    return quality.paired_bins(data, reference, keys)


_KS_SQL = f"""{_HIST_SQL},
  cm AS (SELECT species, hist, abs(sum(a) OVER w / sum(a) OVER k - sum(b) OVER w / sum(b) OVER k) AS gap, a, b FROM bn
    WINDOW w AS (PARTITION BY species, hist ORDER BY bin), k AS (PARTITION BY species, hist)),
  ks AS (SELECT species, hist, max(gap) AS distance, max(gap) * sqrt(sum(a) * sum(b) / (sum(a) + sum(b))) AS z FROM cm GROUP BY ALL),
  pr AS (SELECT species, hist, distance, CASE WHEN z < 0.2 THEN 1.0::DOUBLE ELSE greatest(least(2 * list_sum(list_transform(range(1, 51),
    lambda j: CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END::DOUBLE * exp(-2.0 * j * j * z * z))), 1.0), 0.0) END AS probability FROM ks)"""


@query(
    "p03_kolmogorov_test",
    f"WITH {_KS_SQL} SELECT species, hist, r6(distance) AS distance, r6(probability) AS probability FROM pr",
    ("tracks_extra",),
)
def kolmogorov_test(spark, sf):
    found = quality.kolmogorov_test(_pairs(spark, sf), ["species", "hist"])
    return found.select("species", "hist", r6(C("distance")).alias("distance"), r6(C("probability")).alias("probability"))


@query(
    "p04_chi2_distance",
    f"""WITH {_HIST_SQL}, t AS (SELECT *, sum(a) OVER k AS na, sum(b) OVER k AS nb FROM bn WINDOW k AS (PARTITION BY species, hist))
       SELECT species, hist, r6(sum((nb * a - na * b) * (nb * a - na * b)::DOUBLE / (a + b) / (na * nb))) AS chi2, count(*) - 1 AS ndf FROM t WHERE a + b > 0 GROUP BY ALL""",
    ("tracks_extra",),
)
def chi2_distance(spark, sf):
    found = quality.chi2_distance(_pairs(spark, sf), ["species", "hist"])
    return found.select("species", "hist", r6(C("chi2")).alias("chi2"), "ndf")


# lower tail by its series, whose terms are all positive
_TAIL = """CASE WHEN chi2 > 0 AND ndf > 0 THEN 1 - list_sum(list_transform(range(0, 1000),
  lambda n: exp((ndf / 2.0::DOUBLE + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(ndf / 2.0::DOUBLE + n + 1)))) ELSE 1.0::DOUBLE END"""


@query(
    "p04_chi2_test",
    f"""WITH {_HIST_SQL}, t AS (SELECT *, sum(a) OVER k AS na, sum(b) OVER k AS nb FROM bn WINDOW k AS (PARTITION BY species, hist)),
       c AS (SELECT species, hist, sum((nb * a - na * b) * (nb * a - na * b)::DOUBLE / (a + b) / (na * nb)) AS chi2, count(*) - 1 AS ndf FROM t WHERE a + b > 0 GROUP BY ALL)
       SELECT species, hist, chi2, ndf, r6({_TAIL}) AS probability FROM c""",
    ("tracks_extra",),
)
def chi2_test(spark, sf):
    found = quality.chi2_distance(_pairs(spark, sf), ["species", "hist"])
    return found.withColumn("probability", r6(quality.chi2_probability(C("chi2"), C("ndf"))))


@query(
    "p05_severity",
    f"""WITH {_KS_SQL}, s AS (SELECT species, CASE WHEN species = 3 THEN -1.0 ELSE avg(probability) END AS score FROM pr GROUP BY species
         UNION ALL SELECT 7, 0.0)
       SELECT species, r6(score) AS score, CASE WHEN score >= -1 AND score < 0 THEN 'FATAL' WHEN score > 0 AND score <= 0.002 THEN 'ERROR'
         WHEN score > 0.002 AND score <= 0.5 THEN 'WARNING' WHEN score > 0.5 AND score <= 1 THEN 'INFO' END AS severity FROM s""",
    ("tracks_extra",),
)
def severity(spark, sf):
    tests = quality.kolmogorov_test(_pairs(spark, sf), ["species", "hist"])
    # species 3 lost a reference, species 7 has no histograms
    value = F.when((C("species") == 3) & (C("hist") == 0), F.lit(None)).otherwise(C("probability"))
    scores = tests.select("species", value.alias("value"), F.lit(True).alias("checked"))
    silent = tests.where("species = 0 AND hist = 0").select(
        F.lit(7).alias("species"), F.lit(None).cast("double").alias("value"), F.lit(False).alias("checked")
    )
    found = quality.species_score(scores.unionByName(silent), ["species"])
    return found.select("species", r6(C("score")).alias("score"), quality.severity(C("score")).alias("severity"))


@query(
    "p06_status_bits",
    """WITH u AS (SELECT user_id % 25 AS detector, event_id % 5 AS species, CAST(floor(event_id / 5) AS BIGINT) % 4 AS task, event_id AS seq,
         CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS bit FROM events),
       l AS (SELECT detector, species, task, bit, row_number() OVER (PARTITION BY detector, species, task ORDER BY seq DESC) AS r FROM u),
       w AS (SELECT detector, species, CAST(sum(CASE WHEN bit IS NULL THEN 0 ELSE 1 << (task * 4 + bit) END) AS BIGINT) AS status FROM l WHERE r = 1 GROUP BY ALL)
       SELECT detector, species, status, (status >> 8) & 15 AS task_two, ((status >> 4) & 4) <> 0 AS error_in_one, status <> 0 AS any_set FROM w""",
)
def status_bits(spark, sf):
    bit = F.when(C("event_type") == "click", 0).when(C("event_type") == "view", 1)
    bit = bit.when(C("event_type") == "purchase", 2).when(C("event_type") == "signup", 3)
    updates = base(spark, sf, "events").select(
        (C("user_id") % 25).alias("detector"),
        (C("event_id") % 5).alias("species"),
        (F.floor(C("event_id") / 5) % 4).alias("task"),
        C("event_id").alias("seq"),
        bit.alias("bit"),
    )
    return quality.status_words(updates, ["detector", "species"]).select(
        "detector",
        "species",
        "status",
        quality.task_bits(C("status"), 2).alias("task_two"),
        quality.is_set(C("status"), 1, 2).alias("error_in_one"),
        (C("status") != 0).alias("any_set"),
    )


# name -> (condition in SQL, value in SQL, bins, low, high); j has the track, its details and p, eta, phi
_PIPE = "(flags & 64) <> 0 AND abs(d) < 3 AND abs(dz) < 3"
_CENTRAL = _PIPE + " AND abs(eta) < 0.9"
_GLOBAL_SQL = {
    "its_cluster_fraction": ("(flags & 4) <> 0", "its_ncls / 6.0::DOUBLE", 100, 0, 2),
    "tpc_cluster_fraction": ("(flags & 64) <> 0", "tpc_ncls / 159.0::DOUBLE", 100, 0, 2),
    "azimuth": (_PIPE, "phi", 100, 0, "2 * pi()"),
    "eta": (_PIPE, "eta", 100, -2, 2),
    "tpc_momentum": (_CENTRAL, "p", 50, 0.2, 5),
    "tpc_its_momentum": (_CENTRAL + " AND (flags & 4) <> 0", "p", 50, 0.2, 5),
    "tpc_tof_momentum": (_CENTRAL + " AND tof_signal > 0", "p", 50, 0.2, 5),
    "impact_a_positive": ("z > 0 AND tgl > 0 AND signed1pt > 0", "d * 10", 50, -25, 25),
    "impact_a_negative": ("z > 0 AND tgl > 0 AND NOT signed1pt > 0", "d * 10", 50, -25, 25),
    "impact_c_positive": ("z < 0 AND tgl < 0 AND signed1pt > 0", "d * 10", 50, -25, 25),
    "impact_c_negative": ("z < 0 AND tgl < 0 AND NOT signed1pt > 0", "d * 10", 50, -25, 25),
    "tpc_signal": ("p > 0.4 AND p < 0.5", "tpc_signal", 50, 0, 100),
}
_GLOBAL_FILLS = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(least(floor((({x}) - {lo}) / (({hi}) - ({lo})::DOUBLE) * {n}), {n - 1}) AS BIGINT) AS bin FROM j WHERE {wanted} AND ({x}) >= {lo} AND ({x}) < {hi}"
    for name, (wanted, x, n, lo, hi) in _GLOBAL_SQL.items()
)


@query(
    "p07_global_track_quality",
    f"""WITH k AS (SELECT *, asin(snp) + alpha AS raw FROM tracks JOIN tracks_extra USING (file_id, event_idx, obj_id)),
       j AS (SELECT *, CASE WHEN signed1pt <> 0 THEN sqrt(1 + tgl * tgl) / abs(signed1pt) END AS p, -ln(tan((pi() / 2 - atan(tgl)) / 2)) AS eta,
         CASE WHEN raw < 0 THEN raw + 2 * pi() WHEN raw >= 2 * pi() THEN raw - 2 * pi() ELSE raw END AS phi FROM k)
       SELECT name, bin, count(*) AS content FROM ({_GLOBAL_FILLS}) f GROUP BY name, bin""",
    ("tracks", "tracks_extra"),
)
def global_track_quality(spark, sf):
    """The track histograms of the global quality set, filled in one pass."""
    main = table(spark, sf, "tracks").select(*OBJECT, "alpha", "z", "snp", "tgl", "signed1pt")
    extra = table(spark, sf, "tracks_extra").select(
        *OBJECT, "flags", "its_ncls", "tpc_ncls", "tof_signal", "tpc_signal", "d", "dz"
    )
    p, eta = tracks.momentum(C("tgl"), C("signed1pt")), tracks.eta(C("tgl"))
    joined = main.join(extra, OBJECT).withColumns({"p": p, "eta": eta, "phi": tracks.phi(C("snp"), C("alpha"))})
    its, tpc = any_bit(C("flags"), status.ITS_REFIT), any_bit(C("flags"), status.TPC_REFIT)
    pipe = tpc & (F.abs("d") < 3) & (F.abs("dz") < 3)
    central = pipe & (F.abs("eta") < 0.9)
    side_a, side_c = (C("z") > 0) & (C("tgl") > 0), (C("z") < 0) & (C("tgl") < 0)
    positive, impact = C("signed1pt") > 0, C("d") * 10
    specs = {
        "its_cluster_fraction": (its, C("its_ncls") / 6.0, 100, 0.0, 2.0),
        "tpc_cluster_fraction": (tpc, C("tpc_ncls") / 159.0, 100, 0.0, 2.0),
        "azimuth": (pipe, C("phi"), 100, 0.0, 2 * math.pi),
        "eta": (pipe, C("eta"), 100, -2.0, 2.0),
        "tpc_momentum": (central, C("p"), 50, 0.2, 5.0),
        "tpc_its_momentum": (central & its, C("p"), 50, 0.2, 5.0),
        "tpc_tof_momentum": (central & (C("tof_signal") > 0), C("p"), 50, 0.2, 5.0),
        "impact_a_positive": (side_a & positive, impact, 50, -25.0, 25.0),
        "impact_a_negative": (side_a & ~positive, impact, 50, -25.0, 25.0),
        "impact_c_positive": (side_c & positive, impact, 50, -25.0, 25.0),
        "impact_c_negative": (side_c & ~positive, impact, 50, -25.0, 25.0),
        "tpc_signal": ((C("p") > 0.4) & (C("p") < 0.5), C("tpc_signal"), 50, 0.0, 100.0),
    }
    return quality.filled_together(joined, specs)
