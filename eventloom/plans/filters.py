"""Filters, trigger decoding and event selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import muons, triggers
from eventloom.operators import tables
from eventloom.plans.domain import base, table
from eventloom.plans.registry import query

C = F.col


def _events(spark, sf, *columns):
    return table(spark, sf, "collisions").select("event_idx", "config", *columns)


def with_names(events, defined):
    """Events with their configuration's names; a configuration without any has an empty list."""
    none = F.array().cast(defined.schema["defined"].dataType)
    return events.join(defined, "config", "left").withColumn("defined", F.coalesce("defined", none))


def with_classes(spark, sf, *columns):
    """Collisions with the classes defined for them and those that fired."""
    defined = triggers.name_lists(table(spark, sf, "trigger_classes"), ["config"], "bit")
    df = with_names(_events(spark, sf, "mask", "mask_next", *columns), defined)
    fired = triggers.fired_classes(C("mask"), C("mask_next"), C("defined"))
    return df.withColumn("fired", fired).withColumn("names", triggers.active_names(C("defined")))


FIRED = (
    "CASE WHEN bit < 50 THEN (mask >> least(bit, 49)) & 1 ELSE (mask_next >> greatest(bit - 50, 0)) & 1 END = 1"
)
EVENT_CLASSES = f"""ec AS (SELECT event_idx, c.config, name, cluster, bit, bit IS NOT NULL AND {FIRED} AS fired
  FROM collisions c LEFT JOIN trigger_classes t ON c.config = t.config)"""


@query(
    "c01_filter_by_expression",
    "SELECT event_idx, obj_id, tgl FROM tracks WHERE tgl > 0.1 AND snp <= 0.5",
    ("tracks",),
)
def filter_by_expression(spark, sf):
    return table(spark, sf, "tracks").where((C("tgl") > 0.1) & (C("snp") <= 0.5)).select("event_idx", "obj_id", "tgl")


@query(
    "c02_comparisons",
    """SELECT event_idx, obj_id, x > y AS gt, x < z AS lt, x >= z + y AS ge, x <= 40 AS le, z = 0 AS eq, z <> 0 AS ne
       FROM tracks""",
    ("tracks",),
)
def comparisons(spark, sf):
    return table(spark, sf, "tracks").select(
        "event_idx",
        "obj_id",
        (C("x") > C("y")).alias("gt"),
        (C("x") < C("z")).alias("lt"),
        (C("x") >= C("z") + C("y")).alias("ge"),
        (C("x") <= 40).alias("le"),
        (C("z") == 0).alias("eq"),
        (C("z") != 0).alias("ne"),
    )


@query(
    "c03_and_or",
    "SELECT event_idx, obj_id FROM tracks WHERE (x < 20 AND y > 0) OR z > 10",
    ("tracks",),
)
def and_or(spark, sf):
    return table(spark, sf, "tracks").where(((C("x") < 20) & (C("y") > 0)) | (C("z") > 10)).select("event_idx", "obj_id")


@query(
    "c04_arithmetic_in_predicate",
    "SELECT event_idx, obj_id FROM tracks WHERE x * 2 - 3 > 50 AND y / 4 + 1 < 1.5",
    ("tracks",),
)
def arithmetic_in_predicate(spark, sf):
    df = table(spark, sf, "tracks")
    return df.where((C("x") * 2 - 3 > 50) & (C("y") / 4 + 1 < 1.5)).select("event_idx", "obj_id")


@query(
    "c05_typed_literals",
    """SELECT event_idx, obj_id FROM tracks_extra
       WHERE flags > 20000::BIGINT AND tpc_ncls >= 70 AND tpc_signal < 100.5::DOUBLE AND inner_p IS NOT NULL""",
    ("tracks_extra",),
)
def typed_literals(spark, sf):
    df = table(spark, sf, "tracks_extra")
    return df.where(
        (C("flags") > F.lit(20000).cast("bigint"))
        & (C("tpc_ncls") >= F.lit(70))
        & (C("tpc_signal") < F.lit(100.5))
        & C("inner_p").isNotNull()
    ).select("event_idx", "obj_id")


_PREDICATES = {"known": "tgl > 0.1", "unknown_column": "missing > 1", "not_boolean": "tgl + 1"}


@query(
    "c06_predicate_fits_table",
    """SELECT 'known' AS predicate, true AS fits, count(*) AS n_rows FROM tracks
       UNION ALL SELECT 'unknown_column', false, count(*) FROM tracks
       UNION ALL SELECT 'not_boolean', false, count(*) FROM tracks""",
    ("tracks",),
)
def predicate_fits(spark, sf):
    df = table(spark, sf, "tracks")
    verdicts = [
        F.struct(F.lit(n).alias("predicate"), F.lit(tables.fits(df, F.expr(p))).alias("fits"))
        for n, p in _PREDICATES.items()
    ]
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*verdicts)), "n_rows")


@query(
    "c07_selection_vector",
    "SELECT file_id, event_idx, obj_id FROM tracks WHERE abs(tgl) < 0.3",
    ("tracks",),
)
def selection_vector(spark, sf):
    return tables.selection(table(spark, sf, "tracks"), F.abs("tgl") < 0.3)


@query(
    "c08_status_flags",
    "SELECT event_idx, obj_id, flags FROM tracks_extra WHERE (flags & 68) <> 0",
    ("tracks_extra",),
)
def status_flags(spark, sf):
    df = table(spark, sf, "tracks_extra")
    return df.where(triggers.any_bit(C("flags"), 0x4 | 0x40)).select("event_idx", "obj_id", "flags")


@query(
    "c09_trigger_class_fired",
    f"""WITH {EVENT_CLASSES} SELECT event_idx FROM ec WHERE name = 'NATION_7' AND fired
       UNION SELECT event_idx FROM ec WHERE name = 'NATION_22' AND fired""",
    ("collisions", "trigger_classes"),
)
def trigger_class_fired(spark, sf):
    wanted = F.array(F.lit("NATION_7"), F.lit("NATION_22"))
    df = with_classes(spark, sf)
    return df.where(F.arrays_overlap("fired", wanted)).select("event_idx")


@query(
    "c10_fired_class_names",
    f"""WITH {EVENT_CLASSES}
       SELECT event_idx, coalesce(string_agg(CASE WHEN fired THEN name END, ' ' ORDER BY bit), '') AS names
       FROM ec GROUP BY event_idx""",
    ("collisions", "trigger_classes"),
)
def fired_class_names(spark, sf):
    return with_classes(spark, sf).select("event_idx", F.concat_ws(" ", "fired").alias("names"))


@query(
    "c11_active_names",
    """SELECT c.config, c.names AS classes, i.names AS inputs FROM
         (SELECT config, string_agg(name, ' ' ORDER BY bit) AS names FROM trigger_classes GROUP BY config) c
         JOIN (SELECT config, string_agg(name, ' ' ORDER BY idx) AS names FROM trigger_inputs GROUP BY config) i
         ON c.config = i.config""",
    ("trigger_classes", "trigger_inputs"),
)
def active_names(spark, sf):
    classes = triggers.name_lists(table(spark, sf, "trigger_classes"), ["config"], "bit", out="c")
    inputs = triggers.name_lists(table(spark, sf, "trigger_inputs"), ["config"], "idx", out="i")
    return classes.join(inputs, "config").select(
        "config",
        F.concat_ws(" ", triggers.active_names(C("c"))).alias("classes"),
        F.concat_ws(" ", triggers.active_names(C("i"))).alias("inputs"),
    )


INPUT_FIRED = """CASE WHEN idx < 24 THEN (inputs_l0 >> idx) & 1 WHEN idx < 48 THEN (inputs_l1 >> (idx - 24)) & 1
  ELSE (inputs_l2 >> (idx - 48)) & 1 END = 1"""


def _with_inputs(spark, sf):
    defined = triggers.name_lists(table(spark, sf, "trigger_inputs"), ["config"], "idx")
    df = with_names(_events(spark, sf, "inputs_l0", "inputs_l1", "inputs_l2"), defined)
    fired = triggers.fired_inputs(C("inputs_l0"), C("inputs_l1"), C("inputs_l2"), C("defined"))
    return df.withColumn("fired", fired)


@query(
    "c12_fired_inputs",
    f"""SELECT event_idx, coalesce(string_agg(CASE WHEN {INPUT_FIRED} THEN name END, ' ' ORDER BY idx), '') AS names,
         coalesce(bool_or({INPUT_FIRED} AND name = 'NATION_13'), false) AS one_fired
       FROM collisions c LEFT JOIN trigger_inputs t ON c.config = t.config GROUP BY event_idx""",
    ("collisions", "trigger_inputs"),
)
def fired_inputs(spark, sf):
    return _with_inputs(spark, sf).select(
        "event_idx",
        F.concat_ws(" ", "fired").alias("names"),
        F.array_contains("fired", "NATION_13").alias("one_fired"),
    )


@query(
    "c13_trigger_expression",
    f"""WITH {EVENT_CLASSES},
       f AS (SELECT event_idx, any_value(config) AS config, bool_or(fired AND name = 'NATION_2') AS a,
           bool_or(fired AND name = 'NATION_12') AS b, bool_or(fired AND name = 'NATION_17') AS c FROM ec GROUP BY event_idx)
       SELECT event_idx, CASE WHEN config = 2 THEN a OR (b AND NOT c) ELSE true END AS selected, true AS malformed, true AS empty
       FROM f""",
    ("collisions", "trigger_classes"),
)
def trigger_expression(spark, sf):
    df = with_classes(spark, sf)
    return df.select(
        "event_idx",
        triggers.expression("NATION_2 || (NATION_12 && !NATION_17)", "fired", "names").alias("selected"),
        triggers.expression("NATION_2 && || (", "fired", "names").alias("malformed"),
        triggers.expression("", "fired", "names").alias("empty"),
    )


@query(
    "c14_detector_in_cluster",
    f"""WITH {EVENT_CLASSES},
       cl AS (SELECT CASE WHEN r_regionkey % 2 = 0 THEN 'CENT' ELSE 'MUON' END AS cluster, r_name AS detector FROM region)
       SELECT event_idx, coalesce(bool_or(fired AND ec.cluster IN (SELECT cluster FROM cl WHERE detector = 'ASIA')), false) AS read_out
       FROM ec GROUP BY event_idx""",
    ("collisions", "trigger_classes"),
)
def detector_in_cluster(spark, sf):
    clusters = base(spark, sf, "region").select(
        F.when(C("r_regionkey") % 2 == 0, "CENT").otherwise("MUON").alias("cluster"), C("r_name").alias("detector")
    )
    having = clusters.groupBy("cluster").agg(F.bool_or(C("detector") == "ASIA").alias("has"))
    classes = table(spark, sf, "trigger_classes").join(having, "cluster")
    # only classes whose cluster has the detector can make an event count
    useful = triggers.name_lists(classes.where("has"), ["config"], "bit")
    df = _events(spark, sf, "mask", "mask_next").join(useful, "config", "left")
    fired = triggers.fired_classes(C("mask"), C("mask_next"), C("defined"))
    return df.select("event_idx", F.coalesce(F.size(fired) > 0, F.lit(False)).alias("read_out"))


@query(
    "c15_trigger_functions",
    f"""WITH fn AS (SELECT a.config, a.name AS function, b.name AS other, a.idx AS ia, b.idx AS ib, a.active AND b.active AS is_active
           FROM trigger_inputs a JOIN trigger_inputs b ON a.config = b.config AND b.idx = (a.idx + 10) % 50),
       e AS (SELECT c.config, function, is_active,
           {INPUT_FIRED.replace('idx', 'ia')} AND NOT ({INPUT_FIRED.replace('idx', 'ib')}) AS hit
         FROM collisions c JOIN fn ON c.config = fn.config)
       SELECT config, function, is_active, count(*) FILTER (is_active AND hit) AS n_events FROM e GROUP BY ALL""",
    ("collisions", "trigger_inputs"),
)
def trigger_functions(spark, sf):
    inputs = table(spark, sf, "trigger_inputs")
    other = inputs.select("config", ((C("idx") + 40) % 50).alias("idx"), C("name").alias("other"))
    functions = inputs.join(other, ["config", "idx"]).select(
        "config", C("name").alias("function"), F.concat("name", F.lit(" & !"), "other").alias("logic")
    )
    functions = triggers.function_active(functions, inputs, ["config"])
    hit = C("is_active") & triggers.conjunction(triggers.tokens(C("logic")), C("fired"))
    # events of a configuration that fired the same inputs count together
    events = _with_inputs(spark, sf).groupBy("config", "fired").agg(F.count("*").alias("n"))
    return (
        events.join(functions, "config")
        .groupBy("config", "function", "is_active")
        .agg(F.sum(F.when(hit, C("n")).otherwise(0)).alias("n_events"))
    )


@query(
    "c16_hlt_decision",
    """SELECT doc_id, doc_id % 2 = 1 AND strpos(text, 'the') > 0 AND substr(text, strpos(text, 'the') + 3, 1) = ' ' AS fired
       FROM documents""",
)
def hlt_decision(spark, sf):
    option = F.concat((C("doc_id") % 2).cast("string"), F.lit("x"))
    return base(spark, sf, "documents").select("doc_id", triggers.hlt_fired(option, C("text"), "the").alias("fired"))


@query(
    "c17_incomplete_event",
    "SELECT event_idx, (daq & 12) <> 0 AS incomplete FROM collisions",
    ("collisions",),
)
def incomplete_event(spark, sf):
    return table(spark, sf, "collisions").select("event_idx", triggers.any_bit(C("daq"), 0b1100).alias("incomplete"))


@query(
    "c18_raw_event_selection",
    f"""WITH {EVENT_CLASSES},
       f AS (SELECT event_idx, any_value(config) AS config, bool_or(fired AND name = 'NATION_4') AS veto,
           bool_or(fired AND name IN ('NATION_1', 'NATION_6')) AS trig FROM ec GROUP BY event_idx)
       SELECT event_idx FROM collisions JOIN f USING (event_idx)
       WHERE event_type = 3 AND (pattern & 8) = 8 AND (pattern & 16) = 0 AND ((mask & 4095) <> 0 OR (mask_next & 255) <> 0)
         AND NOT veto AND (f.config <> 1 OR trig) AND event_idx % 2 = 0""",
    ("collisions", "trigger_classes"),
)
def raw_event_selection(spark, sf):
    df = with_classes(spark, sf, "event_type", "pattern")
    chosen = triggers.raw_event_selected(
        event_type=(C("event_type"), 3),
        pattern=C("pattern"),
        detectors=["TPC"],
        without_detectors=["TRD"],
        masks=[(C("mask"), 4095), (C("mask_next"), 255)],
        veto=(C("fired"), ["NATION_4"]),
        trigger=triggers.expression("NATION_1 || NATION_6", "fired", "names"),
        downscale=(C("event_idx"), 2),
    )
    return df.where(chosen).select("event_idx")


@query(
    "c19_trigger_name_selection",
    """WITH n AS (SELECT p_partkey AS class_idx, p_brand || '-B-NOPF-' || p_type AS name FROM part)
       SELECT class_idx, split_part(name, '-', 4) AS cluster,
         name LIKE '%Brand#1%' AS contains, lower(split_part(name, '-', 4)) IN ('economy', 'small') AS in_cluster,
         name LIKE '%Brand#2%' OR lower(split_part(name, '-', 4)) = 'medium' AS veto,
         regexp_matches(name, '(^|[^a-zA-Z0-9_-])Brand#11-B-NOPF-ECONOMY($|[^a-zA-Z0-9_-])') AS whole_name
       FROM n""",
)
def trigger_name_selection(spark, sf):
    name = F.concat("p_brand", F.lit("-B-NOPF-"), "p_type")
    cluster = triggers.cluster_of(C("name"))
    return (
        base(spark, sf, "part")
        .select(C("p_partkey").alias("class_idx"), name.alias("name"))
        .select(
            "class_idx",
            F.get(F.split("name", "-"), F.lit(3)).alias("cluster"),
            C("name").contains("Brand#1").alias("contains"),
            cluster.isin("economy", "small").alias("in_cluster"),
            (C("name").contains("Brand#2") | (cluster == "medium")).alias("veto"),
            C("name").rlike(r"(?<![\w-])Brand#11-B-NOPF-ECONOMY(?![\w-])").alias("whole_name"),
        )
    )


@query(
    "c19_trigger_alias",
    f"""WITH {EVENT_CLASSES},
       f AS (SELECT event_idx, any_value(config) AS config, bool_or(fired AND name = 'NATION_3') AS a,
           bool_or(fired AND name = 'NATION_8') AS b, bool_or(fired AND name = 'NATION_13') AS c FROM ec GROUP BY event_idx)
       SELECT event_idx FROM f WHERE CASE WHEN config = 3 THEN (a OR b) AND NOT c ELSE true END""",
    ("collisions", "trigger_classes"),
)
def trigger_alias(spark, sf):
    text = triggers.alias_expression({"kMinBias": ["NATION_3", "NATION_8"]}, "kMinBias && !NATION_13")
    return with_classes(spark, sf).where(triggers.expression(text, "fired", "names")).select("event_idx")


@query(
    "c20_equipment_selection",
    """SELECT event_id, event_id % 8192 AS equipment FROM events
       WHERE (event_id % 8192) >> 8 = 3 AND user_id % 4 = 1 AND event_id % 8192 BETWEEN 780 AND 1000""",
)
def equipment_selection(spark, sf):
    df = base(spark, sf, "events").select("event_id", "user_id", (C("event_id") % 8192).alias("equipment"))
    detector, _ = triggers.equipment(C("equipment"))
    chosen = (
        (detector == triggers.DETECTOR_BITS["TPC"]) & (C("user_id") % 4 == 1) & C("equipment").between(780, 1000)
    )
    return df.where(chosen).select("event_id", "equipment")


@query(
    "c21_calorimeter_kind",
    "SELECT event_idx, obj_id, cell_number FROM cells WHERE kind = 'phos'",
    ("cells",),
)
def calorimeter_kind(spark, sf):
    return table(spark, sf, "cells").where(C("kind") == "phos").select("event_idx", "obj_id", "cell_number")


CENTRALITY_SQL = """cent AS (SELECT event_idx, m.method, CASE m.method WHEN 'V0M' THEN chi2 * 2 WHEN 'TRK' THEN n_contrib * 1.5
    ELSE z * 5 + 50 END AS percentile, CASE WHEN event_idx % 3 = 0 THEN 1 ELSE 0 END AS quality
  FROM collisions, (VALUES ('V0M'), ('TRK'), ('CL1')) m(method))"""


def centrality(spark, sf):
    """Long form: one row per event and method."""
    methods = F.array(
        F.struct(F.lit("V0M").alias("method"), (C("chi2") * 2).alias("percentile")),
        F.struct(F.lit("TRK").alias("method"), (C("n_contrib") * F.lit(1.5)).alias("percentile")),
        F.struct(F.lit("CL1").alias("method"), (C("z") * 5 + 50).alias("percentile")),
    )
    quality = F.when(C("event_idx") % 3 == 0, 1).otherwise(0)
    return table(spark, sf, "collisions").select("event_idx", F.inline(methods), quality.alias("quality"))


@query(
    "c22_centrality_class",
    f"""WITH {CENTRALITY_SQL} SELECT event_idx, method, percentile >= 10 AND percentile < 40 AND quality = 0 AS in_class,
         percentile >= 10 AND percentile < 40 AS in_class_unchecked FROM cent""",
    ("collisions",),
)
def centrality_class(spark, sf):
    return centrality(spark, sf).select(
        "event_idx",
        "method",
        triggers.in_class(C("percentile"), 10, 40, C("quality")).alias("in_class"),
        triggers.in_class(C("percentile"), 10, 40).alias("in_class_unchecked"),
    )


@query(
    "c23_event_plane_class",
    "SELECT event_idx FROM collisions WHERE atan2(y, x) >= 0.5 AND atan2(y, x) < 1.2",
    ("collisions",),
)
def event_plane_class(spark, sf):
    df = table(spark, sf, "collisions")
    return df.where(triggers.in_class(F.atan2("y", "x"), 0.5, 1.2)).select("event_idx")


@query(
    "c24_bunch_masks",
    """SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n_unmasked, coalesce(embedding[11] <= 0, true) AS masked
       FROM embeddings""",
)
def bunch_masks(spark, sf):
    unmasked = F.filter("embedding", lambda x: x > 0)
    return base(spark, sf, "embeddings").select(
        "vec_id",
        F.size(unmasked).cast("bigint").alias("n_unmasked"),
        F.coalesce(F.get("embedding", F.lit(10)) <= 0, F.lit(True)).alias("masked"),
    )


@query(
    "c25_trigger_chambers",
    """SELECT event_idx, obj_id, ((hits_pattern >> 7) & (hits_pattern >> 3) & 1) + ((hits_pattern >> 6) & (hits_pattern >> 2) & 1)
         + ((hits_pattern >> 5) & (hits_pattern >> 1) & 1) + ((hits_pattern >> 4) & hits_pattern & 1) >= 2 AS matched
       FROM muons""",
    ("muons",),
)
def trigger_chambers(spark, sf):
    matched = muons.chambers_matched(C("hits_pattern"))
    return table(spark, sf, "muons").select("event_idx", "obj_id", matched.alias("matched"))


@query(
    "c26_free_tracklets",
    """SELECT event_idx, obj_id, (used_by & 281470681808895) = 0 AS free_main, (used_by & -281470681808896) = 0 AS free_pure
       FROM tracklets""",
    ("tracklets",),
)
def free_tracklets(spark, sf):
    return table(spark, sf, "tracklets").select(
        "event_idx",
        "obj_id",
        triggers.free_tracklet(C("used_by"), 0).alias("free_main"),
        triggers.free_tracklet(C("used_by"), 1).alias("free_pure"),
    )


@query(
    "c27_anomalous_values",
    """SELECT event_id, CASE WHEN abs(value) > 120 THEN 0 ELSE value END AS cleaned, abs(value) > 120 AS anomalous
       FROM events""",
)
def anomalous_values(spark, sf):
    cleaned, above = triggers.clamped(C("value"), 120.0)
    return base(spark, sf, "events").select("event_id", cleaned.alias("cleaned"), above.alias("anomalous"))


_DETECTOR_VALUES = ", ".join(f"({b}, '{n}')" for n, b in triggers.DETECTOR_BITS.items())


@query(
    "c28_detector_pattern",
    f"""WITH d(bit, name) AS (VALUES {_DETECTOR_VALUES}),
       l AS (SELECT event_idx, string_agg(name, ' ' ORDER BY bit) AS detectors FROM collisions JOIN d ON (pattern >> bit) & 1 = 1
         GROUP BY event_idx)
       SELECT c.event_idx, coalesce(detectors, '') AS detectors,
         CASE WHEN (pattern % 8192) >> 8 < 24 OR (pattern % 8192) >> 8 = 30 THEN (pattern % 8192) >> 8 END AS detector,
         CASE WHEN (pattern % 8192) >> 8 < 24 OR (pattern % 8192) >> 8 = 30 THEN (pattern % 8192) & 255 END AS ddl_index,
         (pattern & 32776) = 32776 AS has_both
       FROM collisions c LEFT JOIN l USING (event_idx)""",
    ("collisions",),
)
def detector_pattern(spark, sf):
    detector, index = triggers.equipment(C("pattern") % 8192)
    both = triggers.detector_pattern(["TPC", "ZDC"])
    return table(spark, sf, "collisions").select(
        "event_idx",
        F.concat_ws(" ", triggers.detector_names(C("pattern"))).alias("detectors"),
        detector.alias("detector"),
        index.alias("ddl_index"),
        (C("pattern").bitwiseAND(F.lit(both)) == both).alias("has_both"),
    )
