"""Every registered query next to its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from eventloom.plans.domain import BASE

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value + 0.0:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r.values()) for r in df.toArrow().to_pylist()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, got) == table(columns, cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_class", "bin", "content"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
