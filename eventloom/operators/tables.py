"""Typed tables: projection, derived columns, positional join, concat, selections."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import schemas

EVENT = ["file_id", "event_idx"]
OBJECT = [*EVENT, "obj_id"]


def project(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Columns by label, in the order asked for; an unknown label is an error."""
    missing = [c for c in labels if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing} among {df.columns}")
    return df.select(*labels)


def persistent(df: DataFrame, stored: Iterable[str]) -> DataFrame:
    """Drop everything that is not stored, e.g. before writing."""
    return df.select(*[c for c in df.columns if c in set(stored)])


def derive(df: DataFrame, name: str, fn: Callable[..., Column], *bound: str, **free) -> DataFrame:
    """A derived column from bound columns and free arguments given at the call."""
    return df.withColumn(name, fn(*[F.col(c) for c in bound], **free))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name, cast to its types; a missing one is an error."""
    return project(df, schema.fieldNames()).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    )


def from_rows(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """A table from row values; names, types and every row must have one length."""
    if len(names) != len(types):
        raise ValueError(f"{len(names)} names for {len(types)} types")
    wrong = [r for r in rows if len(r) != len(names)]
    if wrong:
        raise ValueError(f"row {wrong[0]} does not have {len(names)} values")
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types)))


def from_chunks(spark: SparkSession, chunks: Sequence[pa.RecordBatch]) -> DataFrame:
    """The same from whole column chunks, without touching single values."""
    return spark.createDataFrame(pa.Table.from_batches(chunks))


def columns_to_lists(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """A list column per key, in the order of ``order``.

    For keys whose rows fit in one record, such as the channels of a detector.
    """
    pairs = F.sort_array(F.collect_list(F.struct(order, value)))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p[value]).alias(name))


def positional_join(first: DataFrame, second: DataFrame, keys: Sequence[str] = OBJECT) -> DataFrame:
    """Columns of the first, then of the second table, row by row on the object key.

    Each row of either side must have exactly one partner; a full join keeps a row
    without one, and a condition on the rows stops the job when it meets it, whichever
    columns are used later.
    """
    a = first.withColumn("_in_first", F.lit(True))
    b = second.withColumn("_in_second", F.lit(True))
    joined = a.join(b, list(keys), "full")
    paired = F.col("_in_first") & F.col("_in_second")
    message = F.lit("positional join: the tables differ in their rows")
    # a random number keeps the optimizer from judging the condition before the rows are there
    checked = F.when(F.coalesce(paired, F.lit(False)), F.rand() >= 0).otherwise(F.raise_error(message).cast("boolean"))
    names = [c for c in joined.columns if c not in ("_in_first", "_in_second", *keys)]
    return joined.where(checked).select(*keys, *names)


def concat(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables, with the columns they share, in the first one's order."""
    common = [c for c in first.columns if c in second.columns]
    return first.select(*common).unionByName(second.select(*common))


def concat_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(concat, tables)


def join_all(tables: Sequence[DataFrame], keys: Sequence[str] = OBJECT) -> DataFrame:
    return reduce(lambda a, b: positional_join(a, b, keys), tables)


def fits(df: DataFrame, predicate: Column) -> bool:
    """True if the predicate can be evaluated on the table and is a truth value."""
    try:
        kind = df.select(predicate.alias("p")).schema["p"].dataType
    except AnalysisException:
        return False
    return isinstance(kind, T.BooleanType)


def selection(df: DataFrame, predicate: Column, index: str = "obj_id") -> DataFrame:
    """Positions of the passing rows."""
    return df.where(predicate).select(*[c for c in EVENT if c in df.columns], index)


def row_range(df: DataFrame, first: int, last: int, index: str = "obj_idx") -> DataFrame:
    """Rows whose stored index lies in the closed range."""
    return df.where(F.col(index).between(first, last))


def flat_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as the stored flat table ``name``."""
    return typed(df, schemas.stored(name))
