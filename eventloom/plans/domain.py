"""The detector tables, derived from the tables of a data folder.

Each derived table is one projection of a base table, written as expressions that
mean the same in Spark SQL and in the checking engine, so both sides of a check
start from equal rows.  ``{us}`` stands for microseconds since 2024-01-01 and
``{day}`` for days since 1992-01-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "us": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)",
    "day": "timestampdiff(DAY, TIMESTAMP_NTZ'1992-01-01 00:00:00', o_orderdate)",
}
SQL = {
    "us": "date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts)",
    "day": "date_diff('day', TIMESTAMP '1992-01-01 00:00:00', o_orderdate)",
}

_OBJ_ID = (
    "CAST(l_linenumber AS BIGINT) * 144115188075855872 + l_partkey * 65536"
    " + CAST(l_quantity AS BIGINT) * 1024 + l_suppkey % 1024"
)
_ORBITS = "CAST(floor({us} * 10 / 891) AS BIGINT)"

# table -> (base table, condition or None, {column: expression})
TABLES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "collisions": (
        "orders",
        None,
        {
            "file_id": "o_orderkey % 8",
            "event_idx": "o_orderkey",
            "run": "290000 + o_custkey % 64",
            "config": "CAST(o_orderkey % 5 AS INT)",
            "x": "(o_totalprice % 7 - 3.5) / 100",
            "y": "(o_totalprice % 11 - 5.5) / 100",
            "z": "(o_totalprice % 200 - 100) / 10",
            "cov_xx": "1e-4 * (1 + o_custkey % 5)",
            "cov_xy": "1e-5 * (o_custkey % 3)",
            "cov_yy": "1e-4 * (1 + o_custkey % 7)",
            "cov_zz": "4e-4 * (1 + o_custkey % 9)",
            "chi2": "o_totalprice / 10000",
            "n_contrib": "CAST(o_custkey % 60 AS INT)",
            "period": "o_orderkey >> 5",
            "orbit": "(o_orderkey % 32) * 500000 + o_custkey % 1000",
            "bunch_cross": "o_custkey % 3564",
            "time_stamp": "1500000000 + {day} * 86400 + o_custkey % 86400",
            "event_type": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
            "mask": "((o_custkey % 1048576) * 2654435761) % 1125899906842624",
            "mask_next": "((o_orderkey % 1048576) * 2654468479) % 1125899906842624",
            "inputs_l0": "((o_custkey % 65536) * 40503) % 16777216",
            "inputs_l1": "((o_orderkey % 65536) * 40507) % 16777216",
            "inputs_l2": "(o_custkey * 7 + o_orderkey) % 4096",
            "daq": "(o_custkey * 5) % 256",
            "pattern": "((o_custkey % 65536) * 40503) % 1048576",
        },
    ),
    "tracks": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "x": "1.0 + CAST(l_partkey % 80 AS DOUBLE)",
            "alpha": "(l_suppkey % 18 - 9 + 0.5) * pi() / 9",
            "y": "l_extendedprice % 10 - 5",
            "z": "CAST(l_partkey % 41 - 20 AS DOUBLE)",
            "snp": "(l_quantity - 25.5) / 30",
            "tgl": "(l_tax - 0.04) * 20",
            "signed1pt": "(l_discount - 0.05) * (1 + l_extendedprice / 50000)",
        },
    ),
    "tracks_extra": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "flags": "((l_partkey % 1048576) * 2654435761) % 4294967296",
            "label": "CAST((l_partkey % 200 - 100) * 1000 AS BIGINT)",
            "inner_p": "CASE WHEN l_partkey % 10 > 0 THEN 0.2 + l_extendedprice / 20000 END",
            "its_ncls": "CAST(l_suppkey % 7 AS INT)",
            "its_chi2": "l_extendedprice / 4000",
            "tpc_ncls": "CAST(l_partkey % 160 AS INT)",
            "tpc_chi2": "l_extendedprice / 500",
            "tpc_signal": "40 + l_quantity * 2 + l_extendedprice / 1000",
            "tof_signal": "10000 + l_extendedprice / 7",
            "length": "CASE WHEN l_partkey % 6 > 0 THEN 370 + l_quantity END",
            "d": "l_tax * 50 - 2",
            "dz": "l_discount * 100 - 5",
            "cov_dd": "l_tax",
            "cov_zz": "l_discount / 10",
            "cov_dz": "l_tax * l_discount / 20",
        },
    ),
    "tracks_cov": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "c_yy": "l_quantity / 1000",
            "c_zz": "l_quantity / 500",
            "c_snp_snp": "l_tax / 100",
            "c_tgl_tgl": "l_discount / 100",
            "c_1pt_1pt": "l_extendedprice / 1000000",
        },
    ),
    "cells": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "cell_number": "l_partkey",
            "amplitude": "l_discount * (1 + l_extendedprice / 20000)",
            "time": "l_quantity * 0.000000001",
            "cell_type": "CAST(l_linenumber % 2 AS INT)",
            "kind": "CASE WHEN l_suppkey % 3 = 0 THEN 'phos' ELSE 'emcal' END",
        },
    ),
    "muons": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "inv_bending": "(l_discount - 0.05) * (1 + l_extendedprice / 50000)",
            "theta_x": "(l_quantity - 25.5) / 100",
            "theta_y": "(l_tax - 0.04) * 3",
            "inv_bending_dca": "(l_discount - 0.05) * (1 + l_extendedprice / 60000)",
            "theta_x_dca": "(l_quantity - 25.5) / 110",
            "theta_y_dca": "(l_tax - 0.04) * 2",
            "inv_bending_uncor": "(l_discount - 0.05) * (1 + l_extendedprice / 40000)",
            "theta_x_uncor": "(l_quantity - 25.5) / 90",
            "theta_y_uncor": "(l_tax - 0.04) * 4",
            "chi2": "l_extendedprice / 3000",
            "nhit": "CAST(floor(l_quantity / 5) AS INT)",
            "local_trigger": "l_partkey * 8191 + l_suppkey",
            "hits_pattern": "((l_partkey % 65536) * 31) % 256",
        },
    ),
    "vertices": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "vx": "(l_extendedprice % 5 - 2.5) / 50",
            "vy": "(l_extendedprice % 3 - 1.5) / 50",
            "vz": "(l_extendedprice % 31 - 15.5)",
            "v_xx": "1e-4 * (1 + l_partkey % 4)",
            "v_xy": "2e-5 * (l_partkey % 2)",
            "v_yy": "1e-4 * (1 + l_partkey % 6)",
            "v_zz": "9e-4 * (1 + l_partkey % 8)",
            "v_contrib": "CAST(l_quantity AS INT)",
            "v_bc": "CAST(l_linenumber % 4 - 1 AS INT)",
        },
    ),
    "tracklets": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "theta": "0.3 + l_quantity / 20",
            "phi": "l_extendedprice % 6",
            "used_by": "((l_partkey % 1048576) * 2654435761) >> 3",
        },
    ),
    "legs": (
        "lineitem",
        None,
        {
            "file_id": "l_orderkey % 8",
            "event_idx": "l_orderkey",
            "obj_id": _OBJ_ID,
            "charge": "CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END",
            "px": "(l_quantity - 25.3) / 10",
            "py": "(l_discount - 0.047) * 20",
            "pz": "l_extendedprice / 20000 - 2.1",
            "sx": "l_extendedprice % 13 - 6",
            "sy": "l_extendedprice % 17 - 8",
            "sz": "l_extendedprice % 29 - 14",
        },
    ),
    "pads": (
        "embeddings",
        None,
        {"track_id": "vec_id", "sector": "label", "samples": "embedding"},
    ),
    "counters": (
        "events",
        None,
        {
            "run": "user_id",
            "rec": "event_id",
            "us": "{us}",
            "orbit_abs": _ORBITS,
            "period": _ORBITS + " >> 24",
            "orbit": _ORBITS + " % 16777216",
            "bunch_cross": "event_id % 3564",
            "c0": "CAST(floor({us} / 100) + floor(value * 1000) AS BIGINT) % 4294967296",
            "c1": "CAST(floor({us} / 101) + floor(value * 990) AS BIGINT) % 4294967296",
            "c2": "CAST(floor({us} / 120) + floor(value * 800) AS BIGINT) % 4294967296",
            "c3": "CAST(floor({us} / 150) + floor(value * 600) AS BIGINT) % 4294967296",
            "c4": "CAST(floor({us} / 200) + floor(value * 400) AS BIGINT) % 4294967296",
            "c5": "CAST(floor({us} / 400) + floor(value * 200) AS BIGINT) % 4294967296",
        },
    ),
    "readings": (
        "events",
        None,
        {
            "sensor": "event_type",
            "rec": "event_id",
            "us": "{us}",
            "t": "CAST({us} AS DOUBLE) / 1e6",
            "reading": "value",
        },
    ),
    "crossings": (
        "events",
        None,
        {
            "run": "user_id",
            "rec": "event_id",
            "kind": "event_type",
            "crossing": _ORBITS + " * 3564 + event_id % 3564",
            "orbit_abs": _ORBITS,
            "int1": "event_type IN ('click', 'view')",
            "int2": "event_type IN ('view', 'purchase', 'error')",
        },
    ),
    "error_log": (
        "events",
        None,
        {
            "file_id": "user_id % 8",
            "event_number": "CAST(floor(event_id / 200) AS BIGINT)",
            "ddl_id": "user_id % 2",
            "code": "CASE WHEN event_type IN ('click', 'view', 'error', 'signup') THEN 1 ELSE 2 END",
            "seq": "event_id",
        },
    ),
    "particles": (
        "customer",
        None,
        {
            "file_id": "c_custkey % 2",
            "event_idx": "c_custkey % 10",
            "idx": "CAST(floor(c_custkey / 10) AS BIGINT)",
            "mother": "CASE WHEN c_custkey < 30 THEN -1 ELSE CAST(floor((floor(c_custkey / 10) - 1) / 3) AS BIGINT) END",
            "pdg": (
                "CASE c_custkey % 13 WHEN 0 THEN 211 WHEN 1 THEN -211 WHEN 2 THEN 22 WHEN 3 THEN 111"
                " WHEN 4 THEN 3122 WHEN 5 THEN 2212 WHEN 6 THEN 130 WHEN 7 THEN 421 WHEN 8 THEN 11"
                " WHEN 9 THEN -13 WHEN 10 THEN 321 WHEN 11 THEN 511 ELSE 3212 END"
            ),
            "status": "CAST(CASE WHEN c_nationkey < 20 THEN 1 ELSE 2 END AS INT)",
            "process": "CAST(CASE WHEN c_acctbal < 3000 THEN 4 WHEN c_acctbal < 5000 THEN 5 ELSE 0 END AS INT)",
            "vx": "c_acctbal % 9 - 4.5",
            "vy": "c_acctbal % 7 - 3.5",
            "vz": "c_acctbal % 101 - 50",
        },
    ),
    "catalogue": (
        "part",
        None,
        {
            "entry": "p_partkey",
            "l0": "p_type",
            "l1": "p_brand",
            "first_run": "CASE WHEN p_partkey % 97 = 0 THEN -1 ELSE 290000 + p_partkey % 50 END",
            "last_run": "CASE WHEN p_partkey % 97 = 0 THEN -1 ELSE 290000 + p_partkey % 50 + p_size END",
            "version": "p_partkey % 3",
            "sub_version": "p_partkey % 5",
            "payload": "p_name",
        },
    ),
    "trigger_classes": (
        "nation",
        None,
        {
            "bit": "n_nationkey * 3",
            "name": "n_name",
            "cluster": "CASE WHEN n_regionkey % 2 = 0 THEN 'CENT' ELSE 'MUON' END",
            "config": "n_regionkey",
        },
    ),
    "trigger_inputs": (
        "nation",
        None,
        {
            "idx": "n_nationkey * 2",
            "name": "n_name",
            "active": "n_nationkey % 4 <> 0",
            "config": "n_regionkey",
        },
    ),
}

# table -> (tables it is made of, its SQL); the Spark side is in plans/derived.py
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "decays": (
        ("legs",),
        """SELECT file_id, event_idx,
             arg_min(px, obj_id) FILTER (charge > 0) AS ppx, arg_min(py, obj_id) FILTER (charge > 0) AS ppy,
             arg_min(pz, obj_id) FILTER (charge > 0) AS ppz,
             arg_min(px, obj_id) FILTER (charge < 0) AS npx, arg_min(py, obj_id) FILTER (charge < 0) AS npy,
             arg_min(pz, obj_id) FILTER (charge < 0) AS npz,
             arg_max(px, obj_id) AS bpx, arg_max(py, obj_id) AS bpy, arg_max(pz, obj_id) AS bpz,
             arg_max(sx, obj_id) AS sx, arg_max(sy, obj_id) AS sy, arg_max(sz, obj_id) AS sz,
             min(CASE WHEN charge > 0 THEN obj_id END) AS pos_id,
             min(CASE WHEN charge < 0 THEN obj_id END) AS neg_id, max(obj_id) AS bach_id
           FROM legs GROUP BY file_id, event_idx
           HAVING min(CASE WHEN charge > 0 THEN obj_id END) IS NOT NULL
              AND min(CASE WHEN charge < 0 THEN obj_id END) IS NOT NULL""",
    ),
}

# the base tables of a data folder
BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projection(name: str) -> tuple[str, str | None, dict[str, str]]:
    """Base table, condition and expression of each column of a derived table."""
    source, condition, columns = TABLES[name]
    return source, condition, {c: _fill(e, SPARK) for c, e in columns.items()}


def expressions(name: str) -> tuple[str, list[str]]:
    """Base table and select expressions of a derived table."""
    source, _, columns = projection(name)
    return source, [f"{e} AS {c}" for c, e in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; only the base columns its reader uses are scanned."""
    source, columns = expressions(name)
    df = base(spark, sf_dir, source)
    condition = TABLES[name][1]
    if condition:
        df = df.where(condition)
    return df.selectExpr(*columns)


def _fill(expression: str, dialect: dict[str, str]) -> str:
    for mark, text in dialect.items():
        expression = expression.replace("{" + mark + "}", text)
    return expression


def with_tables(sql: str, tables: tuple[str, ...]) -> str:
    """Prefix ``sql`` with the definitions of the derived tables it names."""
    parts = []
    wanted: list[str] = []
    for name in tables:
        wanted += [n for n in (*VIEWS.get(name, ((), ""))[0], name) if n not in wanted]
    for name in wanted:
        if name in VIEWS:
            parts.append(f"{name} AS ({VIEWS[name][1]})")
            continue
        source, condition, columns = TABLES[name]
        body = ", ".join(f"{_fill(e, SQL)} AS {c}" for c, e in columns.items())
        where = f" WHERE {condition}" if condition else ""
        parts.append(f"{name} AS (SELECT {body} FROM {source}{where})")
    if not parts:
        return sql.strip()
    body = sql.strip()
    for lead in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(lead):
            return f"{lead}{', '.join(parts)}, {body[len(lead):]}"
    return f"WITH {', '.join(parts)} {body}"


def rounding(sql: str) -> str:
    """Write ``r6(x)`` out, with the operations of ``registry.r6``."""
    while "r6(" in sql:
        start = sql.index("r6(")
        depth, at = 1, start + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            at += 1
        sql = f"{sql[:start]}(floor(({sql[start + 3:at - 1]}) * 1e6 + 0.5) / 1e6){sql[at:]}"
    return sql
