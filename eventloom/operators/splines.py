"""Piecewise cubic curves: evaluation, and fitting of one curve per sensor.

A curve is a table of knots (keys, knot ``x0``, coefficients c0..c3 of powers of x - x0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.asof import asof
from eventloom.operators.ordered import blocked, numbered
from eventloom.operators.solve import solved
from eventloom.session import cut_lineage

# Fixed value: a knot is dispensable if the curve without it passes this close (chi2 per 8).
KNOT_CUT = 5.0
POINTS_LEAST = 4


def polynomial(d: Column, coefficients: Sequence[Column], derivative: int = 0) -> Column:
    """Value or derivative (0-3) of c0 + c1 d + c2 d^2 + c3 d^3."""
    c0, c1, c2, c3 = coefficients
    return [
        c0 + d * (c1 + d * (c2 + d * c3)),
        c1 + d * (2 * c2 + d * 3 * c3),
        2 * c2 + 6 * c3 * d,
        6 * c3,
    ][derivative]


def evaluated(
    points: DataFrame, knots: DataFrame, keys: Sequence[str], x: str, block_width: float, derivatives: Sequence[int] = (0,)
) -> DataFrame:
    """The curve at each point: ``y``, and ``y1``..``y3`` for the derivatives asked for.

    The piece of the last knot at or before x is used, before the first knot the first.
    """
    found = asof(points, knots, keys, F.col(x), F.col("x0"), block_width, match="_knot")
    first = knots.groupBy(*keys).agg(F.min_by(F.struct(*knots.columns), "x0").alias("_first"))
    found = found.join(first, list(keys), "left").withColumn(
        "_k", F.coalesce(F.col("_knot"), F.struct(*[F.col(f"_first.{c}").alias(c) for c in knots.columns]))
    )
    d = F.col(x) - F.col("_k.x0")
    parts = [F.col(f"_k.c{i}") for i in range(4)]
    out = {("y" if k == 0 else f"y{k}"): polynomial(d, parts, k) for k in derivatives}
    return found.withColumns(out).drop("_knot", "_first", "_k")


def _hermite(width: Column, y0: Column, s0: Column, y1: Column, s1: Column) -> tuple[Column, ...]:
    """Cubic through two values with two slopes."""
    rise = (y1 - y0) / width
    return y0, s0, (3 * rise - 2 * s0 - s1) / width, (s0 + s1 - 2 * rise) / (width * width)


def local_fits(series: DataFrame, keys: Sequence[str], per_knot: int, block_width: float) -> DataFrame:
    """Initial knots: every ``per_knot`` points a cubic fit, as value, slope and their variances.

    Points (t, y, id) are numbered along t; a chunk's fit also uses half of either
    neighbouring chunk.  The fits are sums per chunk, solved a few numbers at a time.
    """
    keys = list(keys)
    ranked = numbered(series, keys, F.floor(F.col("t") / block_width), ["t", "id"])
    chunk = F.floor((F.col("rank") - 1) / per_knot)
    inside = (F.col("rank") - 1) % per_knot
    neighbour = F.when(inside < per_knot // 2, chunk - 1).otherwise(chunk + 1)
    home = F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))
    guest = F.struct(neighbour.alias("chunk"), F.lit(False).alias("own"))
    spread = ranked.select(*keys, "t", "y", F.inline(F.array(home, guest)))
    # centre and half width of what a chunk's fit covers; chunks beyond either end have no own points
    spans = (
        spread.groupBy(*keys, "chunk")
        .agg(F.min("t").alias("_from"), F.max("t").alias("_to"), F.bool_or("own").alias("_real"))
        .where("_real")
        .select(*keys, "chunk", ((F.col("_from") + F.col("_to")) / 2).alias("x0"), ((F.col("_to") - F.col("_from")) / 2).alias("_w"))
    )
    scaled = spread.join(spans, [*keys, "chunk"])
    u = F.coalesce(F.try_divide(F.col("t") - F.col("x0"), F.col("_w")), F.lit(0.0))
    fits = solved(scaled, [*keys, "chunk", "x0", "_w"], [F.lit(1.0), u, u * u, u * u * u], F.col("y"), F.lit(1.0))
    enough = fits.where((F.col("n_points") > POINTS_LEAST) & F.col("coefficients").isNotNull())
    return enough.select(
        *keys,
        "chunk",
        "x0",
        F.element_at("coefficients", 1).alias("value"),
        (F.element_at("coefficients", 2) / F.col("_w")).alias("slope"),
        (F.element_at("variances", 1) * F.col("residual2")).alias("value_var"),
    )


def without_spare_knots(knots: DataFrame, keys: Sequence[str], block_width: float, rounds: int) -> DataFrame:
    """Drops inner knots that the curve through their neighbours already describes.

    In each round every other inner knot is tested, so that no two neighbouring knots go
    at once.
    """
    keys = list(keys)
    block = F.floor(F.col("x0") / block_width)
    for _ in range(rounds):
        near = {c: F.col(c) for c in ("x0", "value", "slope")}
        df = numbered(knots, keys, block, ["x0"], name="_place")
        df = blocked(
            df, keys, block, ["x0"],
            lag={f"_l_{c}": v for c, v in near.items()}, lead={f"_r_{c}": v for c, v in near.items()},
        )
        width = F.col("_r_x0") - F.col("_l_x0")
        parts = _hermite(width, F.col("_l_value"), F.col("_l_slope"), F.col("_r_value"), F.col("_r_slope"))
        d = F.col("x0") - F.col("_l_x0")
        off = polynomial(d, parts) - F.col("value")
        chi2 = F.try_divide(off * off, F.col("value_var"))
        spare = (F.col("_place") % 2 == 0) & F.col("_l_x0").isNotNull() & F.col("_r_x0").isNotNull() & (chi2 / 8 <= KNOT_CUT)
        # a knot stands for many points, so storing the knots between rounds is cheap
        knots = cut_lineage(df.where(~F.coalesce(spare, F.lit(False))).select(*knots.columns))
    return knots


def curve(knots: DataFrame, keys: Sequence[str], block_width: float) -> DataFrame:
    """Coefficients of the cubic pieces between knots, with continuous slope."""
    block = F.floor(F.col("x0") / block_width)
    near = {c: F.col(c) for c in ("x0", "value", "slope")}
    df = blocked(knots, list(keys), block, ["x0"], lead={f"_r_{c}": v for c, v in near.items()})
    last = F.col("_r_x0").isNull()
    parts = _hermite(
        F.col("_r_x0") - F.col("x0"), F.col("value"), F.col("slope"), F.col("_r_value"), F.col("_r_slope")
    )
    # past the last knot the curve goes on straight
    straight = (F.col("value"), F.col("slope"), F.lit(0.0), F.lit(0.0))
    pieces = [F.when(last, s).otherwise(p).alias(f"c{i}") for i, (p, s) in enumerate(zip(parts, straight))]
    return df.select(*keys, "x0", *pieces)


def fitted(series: DataFrame, keys: Sequence[str], per_knot: int, block_width: float, rounds: int = 2) -> DataFrame:
    """A smooth curve per key through noisy points (t, y, id)."""
    knots = cut_lineage(local_fits(series, keys, per_knot, block_width))
    return curve(without_spare_knots(knots, keys, block_width, rounds), keys, block_width)
