"""The table of named queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.plans import domain
from eventloom.session import applied

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir)``; ``tables`` are the derived tables the SQL names."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(applied(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = domain.rounding(domain.with_tables(sql, tables))
        return fn

    return register


def r6(value: Column) -> Column:
    """Six decimals, so that results of different maths libraries compare equal.

    Only basic arithmetic, which every engine rounds alike, also at a tie.
    """
    return F.floor(value * 1e6 + 0.5) / 1e6
