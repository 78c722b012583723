"""Linear least squares per group: sums in Spark, a small solve per group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SOLUTION = "struct<coefficients:array<double>,variances:array<double>>"


def solved(
    df: DataFrame, keys: Sequence[str], basis: Sequence[Column], y: Column, weight: Column, leading: Column | None = None
) -> DataFrame:
    """Weighted fit of ``y`` by the basis functions, one row per group.

    ``coefficients`` and ``variances`` (of unit-weight errors) are null if the normal
    equations are singular; ``residual2`` is chi2 per degree of freedom.  A group is
    reduced to its sums by partial aggregation, and Python sees only one small matrix per
    group, in Arrow batches.  With ``leading`` (a column of the keys) a group is fitted by its
    first basis functions only, from the same sums; the other coefficients are 0.
    """
    sums = summed(df, keys, basis, y, weight)
    found = solved_sums(sums, keys, len(basis), leading)
    explained = F.aggregate(
        F.zip_with("coefficients", "_right", lambda c, s: c * s), F.lit(0.0), lambda acc, p: acc + p
    )
    chi2 = F.greatest(F.col("_vv") - explained, F.lit(0.0))
    number = F.lit(len(basis)) if leading is None else leading
    return found.withColumn("residual2", F.try_divide(chi2, F.col("n_points") - number)).drop("_vv", "_right")


def summed(df: DataFrame, keys: Sequence[str], basis: Sequence[Column], y: Column, weight: Column) -> DataFrame:
    """The sums of the normal equations per group: ``_m<i>_<j>`` (i <= j), ``_r<i>``, ``_vv`` and ``n_points``."""
    k = len(basis)
    df = df.withColumns({f"_b{i}": b for i, b in enumerate(basis)} | {"_y": y, "_weight": weight})
    b = [F.col(f"_b{i}") for i in range(k)]
    w, v = F.col("_weight"), F.col("_y")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    return df.groupBy(*keys).agg(
        *[F.sum(w * b[i] * b[j]).alias(f"_m{i}_{j}") for i, j in pairs],
        *[F.sum(w * b[i] * v).alias(f"_r{i}") for i in range(k)],
        F.sum(w * v * v).alias("_vv"),
        F.count("*").alias("n_points"),
    )


def solved_sums(sums: DataFrame, keys: Sequence[str], k: int, leading: Column | None = None) -> DataFrame:
    """``coefficients`` and ``variances`` of sums as :func:`summed` gives them, and their right sides ``_right``."""
    at = {(i, j): F.col(f"_m{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)}
    matrix = F.array(*[at[i, j] for i in range(k) for j in range(k)])
    right = F.array(*[F.col(f"_r{i}") for i in range(k)])

    @F.pandas_udf(_SOLUTION)
    def solve(matrices: pd.Series, rights: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        a = np.stack(matrices.to_numpy()).reshape(-1, k, k).astype(float)
        r = np.stack(rights.to_numpy()).astype(float)
        numbers = numbers.to_numpy()
        coefficients, variances = ([None] * len(a) for _ in range(2))
        for n in np.unique(numbers).tolist():
            rows = np.flatnonzero(numbers == n)
            some, side = a[rows, :n, :n], r[rows, :n]
            # scaled to a unit diagonal, so that the rank test does not depend on units
            size = np.sqrt(np.abs(np.diagonal(some, axis1=1, axis2=2)))
            usable = np.isfinite(some).all(axis=(1, 2)) & (size > 0).all(axis=1)
            rows, some, side, size = rows[usable], some[usable], side[usable], size[usable]
            units = size[:, :, None] * size[:, None, :]
            scaled = some / units
            full = np.linalg.matrix_rank(scaled, hermitian=True) == n if len(rows) else np.zeros(0, bool)
            inverse = np.linalg.inv(scaled[full]) / units[full]
            found = (inverse @ side[full][:, :, None])[:, :, 0]
            rest = [0.0] * (k - n)
            for row, one, variance in zip(rows[full].tolist(), found.tolist(), np.diagonal(inverse, axis1=1, axis2=2).tolist()):
                coefficients[row], variances[row] = one + rest, variance + rest
        return pd.DataFrame({"coefficients": coefficients, "variances": variances})

    # marked so that a filter on the result does not solve a second time
    solve = solve.asNondeterministic()
    number = F.lit(k) if leading is None else leading
    return sums.withColumn("_s", solve(matrix, right, number)).select(
        *keys, "n_points", "_vv", right.alias("_right"), "_s.coefficients", "_s.variances"
    )
