"""Reading and writing: nested events, flat tables, record streams and text files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import schemas
from eventloom.operators import conditions, tables
from eventloom.operators.ordered import numbered
from eventloom.plans.domain import base, projection, table
from eventloom.plans.registry import query, r6
from eventloom.session import work_path
from eventloom.sources import nested, sinks, texts

C = F.col
EVENT, OBJECT = tables.EVENT, tables.OBJECT
FLAGS = {"bb_flag": ("o_custkey", 7, 5), "bg_flag": ("o_orderkey", 11, 3)}


def _headers(spark, sf):
    """Header per event; the 64 detector flags follow from the event's numbers."""
    numbers = F.sequence(F.lit(0), F.lit(63))
    counts = table(spark, sf, "tracks").groupBy("event_idx").agg(F.count("*").alias("n_tracks"))

    def pattern(key, step, every):
        return F.transform(numbers, lambda i: (i < 62) & ((C(key) + i * step) % every == 0))

    keys = base(spark, sf, "orders").select(C("o_orderkey").alias("event_idx"), "o_custkey", "o_orderkey")
    fields = ("run", "x", "y", "z", "cov_xx", "cov_xy", "cov_yy", "cov_zz", "chi2")
    df = table(spark, sf, "collisions").select(*EVENT, *fields).join(keys, "event_idx").join(counts, "event_idx", "left")
    # the flags are made after the joins, which carry the numbers only
    df = df.withColumns({"n_tracks": F.coalesce("n_tracks", F.lit(0).cast("bigint")), **{n: pattern(*r) for n, r in FLAGS.items()}})
    return df.select(*EVENT, F.struct(*fields, "n_tracks", *FLAGS).alias("header"))


def nested_cells(spark, sf, *fields):
    """Event records with the chosen fields of their cells only, for readers that use no others."""
    headers = _headers(spark, sf).select(*EVENT, F.struct("header.run").alias("header"))
    return nested.nest(headers, {"cells": table(spark, sf, "cells").select(*OBJECT, *fields)})


def nested_events(spark, sf, kinds=nested.KINDS):
    """Event records with these kinds of objects, from the flat tables; some events have no objects at all."""
    extra = (
        "flags", "inner_p", "its_ncls", "its_chi2", "tpc_ncls", "tpc_chi2", "tpc_signal", "tof_signal", "length",
    )
    cov = ("c_yy", "c_zz", "c_snp_snp", "c_tgl_tgl", "c_1pt_1pt")
    # all five are made of the rows of few tables, which are shuffled in their place
    rows = {}

    def made_of(name, *fields):
        source, condition, columns = projection(name)
        held = rows.setdefault((source, condition), base(spark, sf, source).where(condition or "true"))
        return nested.Projected(held, {c: e for c, e in columns.items() if not fields or c in (*OBJECT, *fields)})

    objects = {
        "tracks": [made_of("tracks"), made_of("tracks_extra", *extra), made_of("tracks_cov", *cov)],
        "cells": made_of("cells"),
        "muons": made_of("muons", "inv_bending", "theta_x", "theta_y", "chi2"),
    }
    objects = {kind: parts for kind, parts in objects.items() if kind in kinds}
    # what follows from other fields of an object is added where the objects are together
    made = {
        "tracks": lambda t: {
            "its_cluster_map": (t["flags"] % 64).cast("int"),
            "trd_ntracklets": (t["tpc_ncls"] % 7).cast("int"),
            "trd_chi2": t["tpc_chi2"] / 10,
            "tof_chi2": t["its_chi2"] / 4,
            "trd_signal": t["tpc_signal"] / 2,
            "cov": F.array(
                t["c_yy"], F.lit(0.0), t["c_zz"], F.lit(0.0), F.lit(0.0), t["c_snp_snp"], F.lit(0.0), F.lit(0.0), F.lit(0.0),
                t["c_tgl_tgl"], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), t["c_1pt_1pt"],
            ),
        },
        "muons": lambda m: {
            "z": m["chi2"] * 3,
            "bending_coor": m["chi2"] * 2,
            "non_bending_coor": m["chi2"] / 2,
            "chi2_match_trigger": m["chi2"] / 8,
        },
    }
    names = {"tracks": nested.TRACK, "muons": nested.MUON}

    def whole(kind):
        def one(o):
            new = made[kind](o)
            return F.struct(*[new.get(n, o[n]).alias(n) for n in (f.split()[0] for f in names[kind].split(", "))])

        return F.transform(kind, one)

    return nested.nest(_headers(spark, sf), objects).withColumns({kind: whole(kind) for kind in made if kind in kinds})


# per application and data folder: the kinds of objects that the records of a folder have
_written: dict[tuple[str, str], dict[tuple[str, ...], str]] = {}


def written_events(spark, sf, kinds=nested.KINDS):
    """Folder with the event records as Parquet files, with these kinds of objects at least.

    Written once per data folder, application and kinds, unless records with more kinds are there.
    """
    folders = _written.setdefault((spark.sparkContext.applicationId, sf), {})
    for held, path in folders.items():
        if set(kinds) <= set(held):
            return path
    path = work_path(spark, "events")
    nested_events(spark, sf, kinds).write.option("compression", "zstd").parquet(path)
    folders[tuple(kinds)] = path
    return path


def events_of(spark, sf, kinds=nested.KINDS):
    """The written records; a reader names the kinds of objects it uses, and scans only its nested fields."""
    return nested.read_events(spark, written_events(spark, sf, kinds))


@query(
    "a01_event_source",
    """SELECT o_orderkey AS event_idx, o_orderkey % 8 AS file_id, coalesce(n, 0) AS n_tracks, coalesce(m, 0) AS n_muons
       FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) AS m FROM lineitem GROUP BY 1) q ON l_orderkey = o_orderkey""",
)
def event_source(spark, sf):
    return events_of(spark, sf, ("muons", "tracks")).groupBy("event_idx", "file_id").agg(
        F.sum(F.size("tracks")).alias("n_tracks"), F.sum(F.size("muons")).alias("n_muons")
    )


@query("a02_input_by_suffix", "SELECT doc_id, source || '/' || doc_id || '.root' AS name FROM documents WHERE doc_id % 3 = 0")
def input_by_suffix(spark, sf):
    suffix = F.when(C("doc_id") % 3 == 0, ".root").when(C("doc_id") % 3 == 1, ".txt").otherwise(".root.bak")
    names = base(spark, sf, "documents").select("doc_id", F.concat("source", F.lit("/"), "doc_id", suffix).alias("name"))
    return nested.with_suffix(names, "name", ".root")


@query(
    "a03_events_per_file_limit",
    """SELECT file_id, event_idx FROM (SELECT o_orderkey % 8 AS file_id, o_orderkey AS event_idx,
         row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS r FROM orders) q WHERE r <= 25""",
)
def events_per_file_limit(spark, sf):
    events = table(spark, sf, "collisions").select(*EVENT)
    return nested.first_events(events, 25, F.floor(C("event_idx") / 65536))


def _flat(name):
    def run(spark, sf):
        return nested.TABLES[name](events_of(spark, sf, nested.kinds_of(name)))

    return run


_ID = "file_id, event_idx, obj_id"
query(
    "a04_flatten_tracks",
    f"""SELECT {_ID}, event_idx AS fCollisionsID, x::FLOAT AS fX, alpha::FLOAT AS fAlpha, y::FLOAT AS fY, z::FLOAT AS fZ, snp::FLOAT AS fSnp,
          tgl::FLOAT AS fTgl, signed1pt::FLOAT AS fSigned1Pt FROM tracks""",
    ("tracks",),
)(_flat("TRACKPAR"))

_COV = {"fCYY": "c_yy", "fCZZ": "c_zz", "fCSnpSnp": "c_snp_snp", "fCTglTgl": "c_tgl_tgl", "fC1Pt21Pt2": "c_1pt_1pt"}
query(
    "a04_flatten_track_covariances",
    f"SELECT {_ID}, " + ", ".join(f"({_COV.get(n, '0')})::FLOAT AS {n}" for n in nested.COVARIANCE) + " FROM tracks_cov",
    ("tracks_cov",),
)(_flat("TRACKPARCOV"))

query(
    "a04_flatten_track_details",
    f"""SELECT {_ID}, coalesce(inner_p, 0)::FLOAT AS fTPCinnerP, flags AS fFlags, (flags % 64)::SMALLINT AS fITSClusterMap, tpc_ncls AS fTPCncls,
          (tpc_ncls % 7)::SMALLINT AS fTRDntracklets, (CASE WHEN its_ncls > 0 THEN its_chi2 / its_ncls ELSE 0 END)::FLOAT AS fITSchi2Ncl,
          (CASE WHEN tpc_ncls > 0 THEN tpc_chi2 / tpc_ncls ELSE 0 END)::FLOAT AS fTPCchi2Ncl, (tpc_chi2 / 10)::FLOAT AS fTRDchi2, (its_chi2 / 4)::FLOAT AS fTOFchi2,
          tpc_signal::FLOAT AS fTPCsignal, (tpc_signal / 2)::FLOAT AS fTRDsignal, tof_signal::FLOAT AS fTOFsignal, length::FLOAT AS fLength FROM tracks_extra""",
    ("tracks_extra",),
)(_flat("TRACKEXTRA"))

query(
    "a04_flatten_cells",
    f"""SELECT {_ID}, event_idx AS fCollisionsID, cell_number AS fCellNumber, amplitude::FLOAT AS fAmplitude, time::FLOAT AS fTime,
          cell_type::TINYINT AS fCellType, (CASE kind WHEN 'emcal' THEN 0 ELSE 1 END)::TINYINT AS fType FROM cells""",
    ("cells",),
)(_flat("CALO"))

query(
    "a04_flatten_muons",
    f"""SELECT {_ID}, event_idx AS fCollisionsID, inv_bending::FLOAT AS fInverseBendingMomentum, theta_x::FLOAT AS fThetaX, theta_y::FLOAT AS fThetaY,
          (chi2 * 3)::FLOAT AS fZ, (chi2 * 2)::FLOAT AS fBendingCoor, (chi2 / 2)::FLOAT AS fNonBendingCoor, chi2::FLOAT AS fChi2, (chi2 / 8)::FLOAT AS fChi2MatchTrigger FROM muons""",
    ("muons",),
)(_flat("MUON"))

_WORDS = {n: f"CAST(list_sum(list_transform(range(62), lambda i: CASE WHEN ({k} + i * {m}) % {d} = 0 THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT)" for n, (k, m, d) in FLAGS.items()}
query(
    "a04_flatten_vzeros",
    f"SELECT o_orderkey % 8 AS file_id, o_orderkey AS event_idx, o_orderkey AS fCollisionsID, {_WORDS['bb_flag']} AS fBBFlag, {_WORDS['bg_flag']} AS fBGFlag FROM orders",
)(_flat("VZERO"))

query(
    "a04_flatten_collisions",
    """SELECT file_id, event_idx, event_idx AS fEventId, x AS fX, y AS fY, z AS fZ, cov_xx AS fCovXX, cov_xy AS fcovXY, 0::DOUBLE AS fCovXZ, cov_yy AS fCovYY,
         0::DOUBLE AS fCovYZ, cov_zz AS fCovZZ, chi2 AS fChi2, (SELECT count(*) FROM lineitem WHERE l_orderkey = event_idx) AS fN,
         0::DOUBLE AS fEventTime, 0::DOUBLE AS fEventTimeRes, 0::SMALLINT AS fEventTimeMask FROM collisions""",
    ("collisions",),
)(_flat("COLLISION"))

query(
    "a04_flatten_timeframes",
    "SELECT DISTINCT file_id, 0::BIGINT AS event_idx, 0::BIGINT AS timestamp FROM collisions",
    ("collisions",),
)(_flat("TIMEFRAME"))


@query(
    "a05_typed_table",
    "SELECT file_id, event_idx, obj_id, event_idx AS fCollisionsID, x::FLOAT AS fX, alpha::FLOAT AS fAlpha, y::FLOAT AS fY, z::FLOAT AS fZ, snp::FLOAT AS fSnp, tgl::FLOAT AS fTgl, signed1pt::FLOAT AS fSigned1Pt FROM tracks",
    ("tracks",),
)
def typed_table(spark, sf):
    names = {"x": "fX", "alpha": "fAlpha", "y": "fY", "z": "fZ", "snp": "fSnp", "tgl": "fTgl", "signed1pt": "fSigned1Pt"}
    df = table(spark, sf, "tracks").withColumnsRenamed(names).withColumn("fCollisionsID", C("event_idx"))
    return tables.typed(df, schemas.stored("TRACKPAR"))


@query("a06_column_chunks", "SELECT event_idx, obj_id, amplitude::FLOAT AS amplitude, r6(amplitude * 2) AS doubled FROM cells", ("cells",))
def column_chunks(spark, sf):
    """Whole columns in and out: the engine's own column batches, no value passes through Python."""
    df = table(spark, sf, "cells")
    doubled = r6(C("amplitude") * 2).alias("doubled")
    return df.select("event_idx", "obj_id", C("amplitude").cast("float").alias("amplitude"), doubled)


@query(
    "a07_list_columns",
    "SELECT vec_id, list_transform(list_filter(embedding, lambda v: v > 0), lambda v: v::DOUBLE) AS hits FROM embeddings",
)
def list_columns(spark, sf):
    channels = base(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("channel", "value"))
    positive = channels.where("value > 0").withColumn("value", C("value").cast("double"))
    return tables.columns_to_lists(positive, ["vec_id"], "channel", "value", "hits")


@query(
    "a08_tree_to_table",
    "SELECT vec_id::INTEGER AS vec_id, label::BIGINT AS label, list_transform(embedding, lambda v: v::DOUBLE) AS embedding FROM embeddings",
)
def tree_to_table(spark, sf):
    wanted = {"vec_id": "int", "label": "bigint", "embedding": "array<double>"}
    return nested.branches(base(spark, sf, "embeddings"), wanted)


_COUNTS = {
    "TRACKPAR": (11, "SELECT count(*) FROM lineitem"),
    "TRACKPARCOV": (18, "SELECT count(*) FROM lineitem"),
    "TRACKEXTRA": (16, "SELECT count(*) FROM lineitem"),
    "CALO": (9, "SELECT count(*) FROM lineitem"),
    "MUON": (12, "SELECT count(*) FROM lineitem"),
    "VZERO": (5, "SELECT count(*) FROM orders"),
    "COLLISION": (17, "SELECT count(*) FROM orders"),
    "TIMEFRAME": (3, "SELECT count(DISTINCT o_orderkey % 8) FROM orders"),
}
_PROFILE = " UNION ALL ".join(
    f"SELECT '{n}' AS description, {columns} AS n_columns, ({count}) AS n_rows" for n, (columns, count) in _COUNTS.items()
)


def _written_tables(spark, sf, only=None):
    """Records written once, flattened from there into a folder of tables (of those asked for); one without rows stays out."""
    flat = nested.flatten(events_of(spark, sf, nested.KINDS if only is None else nested.kinds_of(*only)))
    flat["ZDC"] = tables.typed(
        flat["VZERO"].where("file_id < 0").select(
            *EVENT, "fCollisionsID", F.lit(0).alias("fZEM1Energy"), F.lit(0).alias("fZEM2Energy"), F.lit(0).alias("fFired")
        ),
        schemas.stored("ZDC"),
    )
    folder = work_path(spark, "tables")
    return folder, sinks.write_tables({n: df for n, df in flat.items() if only is None or n in only}, folder)


@query("a09_multi_table_sink", _PROFILE)
def multi_table_sink(spark, sf):
    folder, names = _written_tables(spark, sf)
    return sinks.profile(sinks.read_tables(spark, folder, names))


@query("a10_table_profile", _PROFILE)
def table_profile(spark, sf):
    return nested.profile(events_of(spark, sf))


@query(
    "a11_schema_dump",
    """SELECT 'MUON' AS description, p AS position, f AS field, t AS type, (SELECT count(*) FROM lineitem) AS n_rows FROM (VALUES (0, 'file_id', 'bigint'),
         (1, 'event_idx', 'bigint'), (2, 'obj_id', 'bigint'), (3, 'fCollisionsID', 'bigint'), (4, 'fInverseBendingMomentum', 'float'), (5, 'fThetaX', 'float'), (6, 'fThetaY', 'float'),
         (7, 'fZ', 'float'), (8, 'fBendingCoor', 'float'), (9, 'fNonBendingCoor', 'float'), (10, 'fChi2', 'float'), (11, 'fChi2MatchTrigger', 'float')) v(p, f, t)""",
)
def schema_dump(spark, sf):
    return sinks.schema_of({"MUON": nested.muons(events_of(spark, sf, nested.kinds_of("MUON")))})


@query(
    "a12_table_dictionary",
    """SELECT event_idx, count(*) AS n_cells, r6(sum(amplitude::FLOAT::DOUBLE)) AS energy FROM cells GROUP BY event_idx""",
    ("cells",),
)
def table_dictionary(spark, sf):
    folder, names = _written_tables(spark, sf, only=("CALO",))
    cells = sinks.read_tables(spark, folder, names)["CALO"]
    return cells.groupBy("event_idx").agg(
        F.count("*").alias("n_cells"), r6(F.sum(C("fAmplitude").cast("double"))).alias("energy")
    )


_PER_FILE = 100


@query(
    "a13_counter_files",
    f"""WITH r AS (SELECT run, rec, period, orbit, us, c0, c1, c2, c3, c4, c5, row_number() OVER (PARTITION BY run ORDER BY us, rec) - 1 AS i FROM counters)
       SELECT run * 1000000 + i // {_PER_FILE} AS run, CAST(2 + run % 2 AS INT) AS version, CAST(i % {_PER_FILE} AS INT) AS rec, orbit, period, us // 1000000 AS seconds, us % 1000000 AS microsecs,
         k.class_idx, c0 + k.class_idx AS l0b, c5 AS l2a, CASE WHEN run % 2 = 1 THEN c1 END AS lmb, CASE WHEN run % 2 = 1 THEN rec % 5 END AS time_group
       FROM r, (VALUES (3), (8)) k(class_idx)""",
    ("counters",),
)
def counter_files(spark, sf):
    """Counter files of at most 100 records each, written from the events and read back."""
    rows = numbered(table(spark, sf, "counters"), ["run"], C("period"), ["us", "rec"])
    place = C("rank") - 1
    late = C("run") % 2 == 1
    stamp = F.concat_ws(
        " ", "orbit", "period", F.floor(C("us") / 1000000), C("us") % 1000000, F.when(late, C("rec") % 5)
    )
    line = [
        F.concat_ws(" ", C("c0") + k, "c1", "c2", "c3", "c4", "c5", F.when(late, C("c1")), F.when(late, C("c2")))
        for k in (3, 8)
    ]
    head = F.concat(F.lit("# counters\n"), (2 + C("run") % 2).cast("string"), F.lit("\n"))
    files = (
        rows.withColumns({"file": C("run") * 1000000 + F.floor(place / _PER_FILE), "text": F.concat_ws("\n", stamp, *line)})
        .groupBy("run", "file")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("records"))
        .select(
            "file",
            F.concat(
                head, F.concat_ws(" ", "file", F.lit("2 3 8")), F.lit("\n# records\n"),
                F.concat_ws("\n", F.transform("records", lambda r: r["text"])),
            ).alias("value"),
        )
    )
    path = work_path(spark, "counters")
    # the path is new: tasks put their many files there themselves, not the driver one after the other
    out = files.select("value").write.option("maxRecordsPerFile", 1)
    out.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    found = texts.read_counters(spark, path)
    return found.select(
        "run", "version", "rec", "orbit", "period", "seconds", "microsecs", "class_idx", "l0b", "l2a", "lmb", "time_group"
    )


@query(
    "a14_slow_control_files",
    """WITH e AS (SELECT event_id, event_type AS name, date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 AS t, value FROM events)
       SELECT name, CASE name WHEN 'click' THEN 'i' WHEN 'view' THEN 'b' WHEN 'error' THEN 's' ELSE 'f' END AS type, t AS ts,
         CASE name WHEN 'click' THEN [floor(value)::DOUBLE, event_id::DOUBLE] WHEN 'view' THEN [(event_id % 2)::DOUBLE, 1::DOUBLE] WHEN 'error' THEN NULL ELSE [value, event_id::DOUBLE] END AS numbers,
         CASE WHEN name = 'error' THEN ['e' || event_id, 'x'] END AS texts FROM e WHERE t BETWEEN 86400 AND 2000000""",
)
def slow_control_files(spark, sf):
    """Lines of up to 20 entries per sensor, written from the events and read back."""
    events = base(spark, sf, "events").select(C("event_id").alias("rec"), "value")
    rows = table(spark, sf, "readings").drop("reading").join(events, "rec")
    ranked = numbered(rows, ["sensor"], F.floor(C("us") / 3.6e9), ["us", "rec"])
    types = {"click": "i", "view": "b", "error": "s"}
    kind = F.lit("f")
    for name, letter in types.items():
        kind = F.when(C("sensor") == name, letter).otherwise(kind)
    first = F.when(C("sensor") == "click", F.floor("value").cast("string")).when(
        C("sensor") == "view", (C("rec") % 2).cast("string")
    )
    first = first.when(C("sensor") == "error", F.concat(F.lit("e"), "rec")).otherwise(C("value").cast("string"))
    second = F.when(C("sensor") == "view", F.lit("1")).when(C("sensor") == "error", F.lit("x")).otherwise(C("rec").cast("string"))
    entry = F.concat_ws("\t", first, second, C("t").cast("string"))
    lines = (
        ranked.select("sensor", kind.alias("kind"), F.floor(C("rank") / 20).alias("line"), "rank", entry.alias("entry"))
        .groupBy("sensor", "kind", "line")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "entry"))).alias("entries"))
        .select(
            F.concat_ws(
                "\t", "line", "sensor", F.concat("kind", F.lit(":2")), F.size("entries"),
                F.concat_ws("\t", F.transform("entries", lambda e: e["entry"])),
            ).alias("value")
        )
    )
    marked = lines.unionByName(lines.limit(1).select(F.lit("END_OF_BLOCK\t1\t2\t3\t4").alias("value")))
    path = work_path(spark, "slow-control")
    marked.write.text(path)
    return texts.read_slow_control(spark, path, 86400.0, 2000000.0)


@query(
    "a15_resource_log",
    """SELECT event_id AS id0, r6(value / 3 - value / 7) AS deltaT, r6(value / 3 - 1) AS T, value * 2 AS VM, r6(value * 2 - value / 5) AS deltaVM, value AS RM, r6(value - value / 9) AS deltaRM FROM events""",
)
def resource_log(spark, sf):
    v = C("value")
    log = base(spark, sf, "events").select(
        F.lit("node").alias("hname"), C("event_type").alias("sname"), C("event_id").alias("id0"), F.lit(0).alias("id1"),
        F.lit(0).alias("id2"), F.lit(0).alias("id3"), F.lit(1.0).alias("first"), (v / 3).alias("stampSec"), (v / 7).alias("stampOldSec"),
        (v * 2).alias("memVirtual"), (v / 5).alias("memVirtualOld"), v.alias("memResident"), (v / 9).alias("memResidentOld"),
    )
    path = work_path(spark, "watch")
    log.write.option("sep", "\t").option("header", "true").csv(path)
    found = texts.read_resource_log(spark, path)
    rounded = [r6(C(n)).alias(n) for n in ("deltaT", "T", "deltaVM", "deltaRM")]
    return found.select(C("id0").cast("bigint").alias("id0"), *rounded, "VM", "RM")


@query(
    "a16_disk_usage",
    """SELECT l_extendedprice * 1024 AS size, './' || l_returnflag || '/' || l_suppkey || '/f' || l_partkey || '_' || l_orderkey || '_' || l_linenumber AS dir, 3 AS depth,
         'f' || l_partkey || '_' || l_orderkey || '_' || l_linenumber AS basename, l_extendedprice AS "sizeMB", l_extendedprice / 1024 AS "sizeGB" FROM lineitem""",
)
def disk_usage(spark, sf):
    name = F.concat_ws("_", F.concat(F.lit("f"), "l_partkey"), "l_orderkey", "l_linenumber")
    listing = base(spark, sf, "lineitem").select(
        (C("l_extendedprice") * 1024).alias("size"), F.concat_ws("/", F.lit("."), "l_returnflag", "l_suppkey", name).alias("dir")
    )
    path = work_path(spark, "usage")
    listing.write.option("sep", " ").csv(path)
    found = texts.read_disk_usage(spark, path)
    return found.select("size", "dir", "depth", "basename", "sizeMB", "sizeGB")


@query(
    "a17_record_streams",
    "SELECT event_type AS stream, count(*) AS n, r6(sum(value)) AS total FROM events GROUP BY 1",
)
def record_streams(spark, sf):
    records = base(spark, sf, "events").select(C("event_type").alias("stream"), "event_id", "value")
    schema = T.StructType.fromDDL("event_id bigint, value double")
    path = work_path(spark, "streams")
    sinks.write_streams(records, "stream", schema, path)
    return sinks.read_streams(spark, path).groupBy("stream").agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


@query(
    "a18_catalogue_from_names",
    """SELECT p_partkey AS entry, p_type AS l0, p_brand AS l1, p_partkey % 500 AS first_run, p_partkey % 500 + p_size AS last_run, p_partkey % 3 AS version, p_partkey % 5 AS sub_version
       FROM part WHERE p_partkey % 10 <> 9""",
)
def catalogue_from_names(spark, sf):
    ending = F.when(C("p_partkey") % 10 == 9, F.lit(".bak")).otherwise(F.lit(".root"))
    name = F.concat(
        F.lit("Run"), C("p_partkey") % 500, F.lit("_"), C("p_partkey") % 500 + C("p_size"), F.lit("_v"), C("p_partkey") % 3,
        F.lit("_s"), C("p_partkey") % 5, ending,
    )
    paths = base(spark, sf, "part").select(
        C("p_partkey").alias("entry"), F.concat_ws("/", "p_type", "p_brand", name).alias("path")
    )
    pieces = F.split("path", "/")
    parsed = paths.select("entry", pieces[0].alias("l0"), pieces[1].alias("l1"), conditions.parse_entry_name(pieces[2]).alias("e"))
    return parsed.where("e IS NOT NULL").select("entry", "l0", "l1", "e.*")


@query(
    "a19_chained_stream",
    """SELECT file_id, event_idx, row_number() OVER (ORDER BY (file_id * 5) % 8, event_idx) - 1 AS position FROM collisions""",
    ("collisions",),
)
def chained_stream(spark, sf):
    events = table(spark, sf, "collisions").select(*EVENT)
    files = events.select("file_id").distinct().withColumn("file_pos", (C("file_id") * 5) % 8)
    return nested.chained(events, files, F.floor(C("event_idx") / 65536))


@query(
    "a20_tag_update",
    """WITH t AS (SELECT c_custkey AS run, c_mktsegment AS beam, c_acctbal AS field FROM customer),
       n AS (SELECT o_custkey AS run, max(o_orderstatus) AS beam, max(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END) AS field FROM orders GROUP BY 1)
       SELECT t.run, coalesce(n.beam, t.beam) AS beam, coalesce(n.field, t.field) AS field FROM t LEFT JOIN n ON n.run = t.run""",
)
def tag_update(spark, sf):
    tags = base(spark, sf, "customer").select(C("c_custkey").alias("run"), C("c_mktsegment").alias("beam"), C("c_acctbal").alias("field"))
    runs = (
        base(spark, sf, "orders")
        .groupBy(C("o_custkey").alias("run"))
        .agg(F.max("o_orderstatus").alias("beam"), F.max(F.when(C("o_orderkey") % 2 == 0, C("o_totalprice"))).alias("field"))
    )
    return conditions.refreshed(tags, runs, ["run"])
