"""Ordered (window) operators that do not put one key into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts all rows of a key in one
task, so a sensor or a run holding a third of the table stalls the job.  Here a
key is cut into *blocks*: columns that only ever grow along the order (an hour,
a time-stamp period, a value bin).  One partially aggregated pass gives what each
block passes on (edge rows, sums); a window over these few block rows per key
turns that into what each block inherits; the rows themselves are only ever
sorted inside (key, block).

A null key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def joined_on(rows: DataFrame, passed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal keys, null being equal to null."""
    other = passed.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"_on_{k}"]) for k in keys])
    return rows.join(other, same, "left").drop(*[f"_on_{k}" for k in keys])


def blocked(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str],
    *,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ordered columns computed per key, block by block.

    ``lag`` / ``lead``: value of the neighbouring row; ``running``: sum up to and
    including the row; ``last``: latest non-null value up to and including the row.
    ``block`` must not decrease along ``order`` within a key, and ``order`` must be
    total within a key.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    running, last = dict(running or {}), dict(last or {})
    keys, order = list(keys), list(order)
    position = F.struct(*order)

    df = df.withColumn("_block", block)
    edges, inherit = [], []
    across = Window.partitionBy(*keys).orderBy("_block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    if lag:
        edges.append(F.max_by(F.struct(*[c.alias(n) for n, c in lag.items()]), position).alias("_tail"))
        inherit.append(F.lag("_tail").over(across).alias("_tail_in"))
    if lead:
        edges.append(F.min_by(F.struct(*[c.alias(n) for n, c in lead.items()]), position).alias("_head"))
        inherit.append(F.lead("_head").over(across).alias("_head_in"))
    for i, expr in enumerate(running.values()):
        edges.append(F.sum(expr).alias(f"_sum{i}"))
        inherit.append(F.sum(f"_sum{i}").over(before).alias(f"_sum{i}_in"))
    for i, expr in enumerate(last.values()):
        edges.append(F.max_by(expr, F.when(expr.isNotNull(), position)).alias(f"_last{i}"))
        inherit.append(F.last(f"_last{i}", ignorenulls=True).over(before).alias(f"_last{i}_in"))

    passed = (
        df.groupBy(*keys, "_block").agg(*edges).select(*keys, "_block", *inherit)
    )
    rows = joined_on(df, passed, [*keys, "_block"])

    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_row = F.row_number().over(inside) == 1
    last_row = F.lead(F.lit(1)).over(inside).isNull()
    out = {}
    for name, expr in lag.items():
        out[name] = F.when(first_row, F.col("_tail_in")[name]).otherwise(F.lag(expr).over(inside))
    for name, expr in lead.items():
        out[name] = F.when(last_row, F.col("_head_in")[name]).otherwise(F.lead(expr).over(inside))
    for i, (name, expr) in enumerate(running.items()):
        inherited = F.coalesce(F.col(f"_sum{i}_in"), F.lit(0))
        out[name] = inherited + F.coalesce(F.sum(expr).over(upto), F.lit(0))
    for i, (name, expr) in enumerate(last.items()):
        out[name] = F.coalesce(F.last(expr, ignorenulls=True).over(upto), F.col(f"_last{i}_in"))
    helper = ["_block", "_tail_in", "_head_in"]
    helper += [f"_sum{i}_in" for i in range(len(running))] + [f"_last{i}_in" for i in range(len(last))]
    return rows.withColumns(out).drop(*helper)


def numbered(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[str], name: str = "rank"
) -> DataFrame:
    """1-based position of each row within its key."""
    return blocked(df, keys, block, order, running={name: F.lit(1).cast("bigint")})


def stepped(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str],
    prev: Mapping[str, Column],
    steps: Mapping[str, Column],
    uses: Sequence[str],
) -> DataFrame:
    """Previous row's values, and how often a comparison with them held so far.

    ``prev`` names values of the previous row in the key (null for the first one).  Each of
    ``steps`` is a condition over the row (columns ``uses``) and those names; its column counts
    the rows up to here for which it is true.  Both come out of one pass: a block passes
    on its last row, its first row, and the steps between them; whether its first row is
    a step is decided between the blocks.
    """
    keys, order = list(keys), list(order)
    df = df.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    position = F.struct(*order)
    first = F.row_number().over(inside) == 1
    rows = df.withColumns({n: F.lag(c).over(inside) for n, c in prev.items()} | {"_first": first})

    def taken(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("bigint")

    rows = rows.withColumns(
        {f"_step_{n}": F.when(F.col("_first"), F.lit(0).cast("bigint")).otherwise(taken(c)) for n, c in steps.items()}
    )
    # the values of a row as its successor will see them
    passed_on = F.struct(*[c.alias(n) for n, c in prev.items()])
    edges = rows.groupBy(*keys, "_block").agg(
        F.max_by(passed_on, position).alias("_tail"),
        F.min_by(F.struct(*uses), position).alias("_head"),
        *[F.sum(f"_step_{n}").alias(f"_sum_{n}") for n in steps],
    )
    across = Window.partitionBy(*keys).orderBy("_block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    met = edges.withColumn("_tail", F.lag("_tail").over(across)).select(
        *keys,
        "_block",
        *[F.col(f"_head.{c}").alias(c) for c in uses if c not in keys],
        *[F.col(f"_tail.{n}").alias(n) for n in prev],
        *[f"_sum_{n}" for n in steps],
    )
    met = met.withColumns({f"_enter_{n}": taken(c) for n, c in steps.items()})
    inherited = met.select(
        *keys,
        "_block",
        *[F.col(n).alias(f"_in_{n}") for n in prev],
        *[
            (F.coalesce(F.sum(F.col(f"_sum_{n}") + F.col(f"_enter_{n}")).over(before), F.lit(0)) + F.col(f"_enter_{n}")).alias(f"_base_{n}")
            for n in steps
        ],
    )
    joined = joined_on(rows, inherited, [*keys, "_block"])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {n: F.when(F.col("_first"), F.col(f"_in_{n}")).otherwise(F.col(n)) for n in prev}
    out |= {n: F.col(f"_base_{n}") + F.sum(f"_step_{n}").over(upto) for n in steps}
    helpers = ["_block", "_first", *[f"_in_{n}" for n in prev]]
    helpers += [f"_{k}_{n}" for n in steps for k in ("step", "base")]
    return joined.withColumns(out).drop(*helpers)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str],
    values: Mapping[str, Column],
    starts,
    uses: Sequence[str],
    name: str = "island",
) -> DataFrame:
    """Number runs of consecutive rows.

    ``values`` are available as the previous row's ``_prev_<name>``; the callable ``starts()``
    returns the Column telling that a new run begins here, from those and the columns
    ``uses``.  A key's first row always begins run 1.
    """
    prev = {f"_prev_{n}": c for n, c in values.items()} | {"_prev_row": F.lit(True)}
    begins = F.col("_prev_row").isNull() | F.coalesce(starts(), F.lit(False))
    return stepped(df, keys, block, order, prev, {name: begins}, uses).drop(*prev)
