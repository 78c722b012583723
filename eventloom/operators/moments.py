"""Sums with Gaussian weights over many points from the moments of cells.

With a a request's and b a point's distance from the middle of the point's cell, in kernel widths, a weight is
exp(-2 (a - b)^2) = exp(-2 a^2) exp(4 a b) exp(-2 b^2). The power series of the factor in the middle turns a sum over points
into a polynomial in a, whose coefficients are the moments of exp(-2 b^2) over the points, whatever the request. The
series ends where its terms are below double precision. The work per request does not follow the density of the points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from eventloom.session import stored

# Fixed value: largest width of a cell in kernel widths.
CELL = 0.375
_CHUNK = 2000


@dataclass(frozen=True)
class Cells:
    """Cells of a window of ``sigmas`` kernel widths to either side, and the series that belongs to them."""

    width: float
    sigmas: float
    degree: int

    @property
    def reach(self) -> float:
        return self.sigmas * self.width

    @property
    def step(self) -> float:
        return self.reach / math.ceil(self.sigmas / CELL)

    @property
    def terms(self) -> int:
        half = self.step / self.width / 2
        largest = 4 * (self.sigmas + half) * half
        k, term = 1, 1.0
        while term > 1e-17 * math.exp(-largest):
            term *= largest / k
            k += 1
        return k

    def sums(self) -> list[str]:
        """Columns of the sums, named as in ``solve.summed``."""
        n = self.degree + 1
        return [f"_m{i}_{j}" for i in range(n) for j in range(i, n)] + [f"_r{i}" for i in range(n)]

    def cell(self, at: Column) -> Column:
        return F.floor(at.cast("double") / self.step)

    def of_points(self, at: np.ndarray, cell: np.ndarray, y: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Number, bare moments and moments with y of each point; 0 of rows that are not used."""
        b = (at - (cell + 0.5) * self.step) / self.width
        powers = np.empty((len(b), self.terms + 2 * self.degree))
        powers[:, 0] = np.exp(-2 * b * b)
        for k in range(1, powers.shape[1]):
            powers[:, k] = powers[:, k - 1] * b
        out = np.concatenate([np.ones((len(b), 1)), powers, powers[:, : self.terms + self.degree] * y[:, None]], axis=1)
        out[~used] = 0
        return out

    def at_requests(self, moments: np.ndarray, cell: np.ndarray, t: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """The sums at n requests over m cells each: moments (n or 1, m, all), cell (n or 1, m), t and centre (n)."""
        terms, degree = self.terms, self.degree
        middle = (cell + 0.5) * self.step
        a, c = (t[:, None] - middle) / self.width, (middle - centre[:, None]) / self.width
        bare, filled = moments[..., 1 : 1 + terms + 2 * degree], moments[..., 1 + terms + 2 * degree :]

        def coefficients(k: int) -> np.ndarray:
            return np.concatenate([bare[..., k : k + 2 * degree + 1], filled[..., k : k + degree + 1]], axis=-1)

        z = 4 * a[..., None]
        total = np.broadcast_to(coefficients(terms - 1), (*a.shape, 3 * degree + 2))
        for k in range(terms - 1, 0, -1):
            total = coefficients(k - 1) + total * z / k
        total = total * np.exp(-2 * a * a)[..., None]

        def moved(first: int, p: int) -> np.ndarray:
            """Powers of the distance from the request's centre instead of the cell's middle, over all cells."""
            return sum(math.comb(p, q) * c ** (p - q) * total[..., first + q] for q in range(p + 1)).sum(axis=1)

        s = [moved(0, p) for p in range(2 * degree + 1)]
        n = degree + 1
        found = [s[i + j] for i in range(n) for j in range(i, n)] + [moved(2 * degree + 1, i) for i in range(n)]
        return np.stack(found, axis=1)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.fill_null(batch.column(name).cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)


def _starts(batch: pa.RecordBatch, last: pa.RecordBatch | None, group: Sequence[str]) -> np.ndarray:
    """Rows that begin a group, in rows sorted by group after a last row."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = last is None
    for name in group:
        column = batch.column(name)
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        if last is not None:
            new[0] |= column[0] != last.column(name)[0]
    return np.flatnonzero(new)


def _result(rows: pa.RecordBatch, names: Sequence[str], cells: Cells, found: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    return [*[rows.column(c) for c in names], *[pa.array(x) for x in found.T], pa.array(np.rint(n).astype(np.int64))]


def _running(cells: Cells, keys: Sequence[str], names: Sequence[str]):
    """Rows sorted by group and turn: sums at each mark of the points before it, and the moments of each whole cell."""
    group = [*keys, "_side", "_cell"]
    columns = [*names, *cells.sums(), "n_points"]

    def whole(row: pa.RecordBatch, sums: np.ndarray) -> pa.RecordBatch:
        values = [row.column(c) if c in keys else pa.nulls(1, row.column(c).type) for c in names]
        values += [pa.nulls(1, pa.float64()) for _ in cells.sums()] + [pa.nulls(1, pa.int64())]
        values += [row.column("_cell"), pa.array([sums.tolist()], pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(values, [*columns, "_cell", "_moments"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums = None, np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, point = _numbers(batch, "_cell"), batch.column("_turn").to_numpy() == 1
            own = cells.of_points(_numbers(batch, "_at"), cell, _numbers(batch, "_value"), point)
            ends = batch.column("_side").to_numpy()
            starts = set(_starts(batch, last, group).tolist())
            borders = [*sorted({0} | starts), batch.num_rows]
            reached = []
            for a, b in zip(borders, borders[1:]):
                if a in starts:
                    if last is not None and last.column("_side")[0].as_py() == 1 and sums[0]:
                        yield whole(last, sums)
                    sums = np.zeros(own.shape[1])
                marks = np.flatnonzero(~point[a:b])
                if len(marks):
                    upto = sums + np.cumsum(own[a:b], axis=0)
                    reached.append(upto[marks])
                    sums = upto[-1]
                else:
                    sums = sums + own[a:b].sum(axis=0)
                last = batch.slice(b - 1, 1)
            rows = batch.filter(pa.array(~point))
            if rows.num_rows:
                moments, at = np.concatenate(reached), cell[~point]
                found = cells.at_requests(moments[:, None, :], at[:, None], _numbers(rows, "t"), _numbers(rows, "_centre"))
                values = _result(rows, names, cells, found, moments[:, 0])
                nothing = [pa.nulls(rows.num_rows, pa.int64()), pa.nulls(rows.num_rows, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*values, *nothing], [*columns, "_cell", "_moments"])
        if last is not None and last.column("_side")[0].as_py() == 1 and sums[0]:
            yield whole(last, sums)

    return run


def _inside(cells: Cells, keys: Sequence[str], names: Sequence[str]):
    """Rows sorted by group, the moments of its cells before its requests: the sums at each request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = set(_starts(batch, last, [*keys, "_first", "_last"]).tolist())
            borders = [*sorted({0} | starts), batch.num_rows]
            for a, b in zip(borders, borders[1:]):
                if a in starts:
                    held = []
                part = batch.slice(a, b - a)
                request = part.column("_moments").is_null()
                of_cells = part.filter(pc.invert(request))
                held += list(zip(of_cells.column("_cell").to_pylist(), of_cells.column("_moments").to_pylist()))
                rows = part.filter(request)
                if held and rows.num_rows:
                    at, moments = np.array([x for x, _ in held], float)[None], np.array([m for _, m in held])[None]
                    for i in range(0, rows.num_rows, _CHUNK):
                        some = rows.slice(i, _CHUNK)
                        found = cells.at_requests(moments, at, _numbers(some, "t"), _numbers(some, "_centre"))
                        n = np.full(some.num_rows, moments[0, :, 0].sum())
                        yield pa.RecordBatch.from_arrays(_result(some, names, cells, found, n), [*names, *cells.sums(), "n_points"])
            last = batch.slice(batch.num_rows - 1, 1)

    return run


def window_sums(
    asked: DataFrame, series: DataFrame, keys: Sequence[str], width: float, sigmas: float, degree: int
) -> DataFrame:
    """Sums over the points with t - reach < time <= t + reach, per request: up to three parts, to be added.

    ``asked`` has the keys (not null), ``t`` and ``_centre``, from which powers are taken; ``series`` the keys, ``t`` and ``y``.
    The columns are those of ``asked`` and the sums of ``solve.summed``. A window is all points of the cells inside it, the last
    ones of the cell where it begins and the first ones of the cell where it ends; the latter two are running
    moments, against time and along it, so that nothing is ever subtracted.
    """
    cells = Cells(float(width), float(sigmas), degree)
    keys, names = list(keys), list(asked.columns)
    sums = [StructField(name, DoubleType()) for name in cells.sums()] + [StructField("n_points", LongType())]
    schema = StructType([*asked.schema.fields, *sums])
    running = StructType([*schema.fields, StructField("_cell", LongType()), StructField("_moments", ArrayType(DoubleType()))])

    # turn 1 is a point: at the same time it counts where a window ends, and not where it begins
    marks = [
        asked.withColumns({"_at": F.col("t").cast("double") + side * cells.reach, "_side": F.lit(side), "_turn": F.lit(turn)})
        for side, turn in ((-1, 0), (1, 2))
    ]
    marks = marks[0].unionByName(marks[1])
    points = series.dropna(subset=[*keys, "t"]).select(
        *keys, F.col("t").cast("double").alias("_at"), F.col("y").cast("double").alias("_value"), F.lit(1).alias("_turn"),
        F.explode(F.array(F.lit(-1), F.lit(1))).alias("_side"),
    )
    rows = marks.unionByName(points, allowMissingColumns=True).withColumn("_cell", cells.cell(F.col("_at")))
    group = [*keys, "_side", "_cell"]
    rows = rows.repartition(*group).sortWithinPartitions(*group, F.col("_side") * F.col("_at"), "_turn")
    found = stored(rows.mapInArrow(_running(cells, keys, names), running), "moments")
    ends = found.where("_moments IS NULL").drop("_cell", "_moments")
    whole = found.where("_moments IS NOT NULL").select(*keys, "_cell", "_moments")

    first, last = (cells.cell(F.col("t").cast("double") + side * cells.reach) for side in (-1, 1))
    requests = asked.withColumns({"_first": first, "_last": last})
    cell = F.explode(F.sequence(F.col("_first") + 1, F.col("_last") - 1))
    wanted = requests.where("_last - _first > 1").select(*keys, "_first", "_last").distinct().withColumn("_cell", cell)
    rows = requests.unionByName(wanted.join(whole, [*keys, "_cell"]), allowMissingColumns=True)
    group = [*keys, "_first", "_last"]
    rows = rows.repartition(*group).sortWithinPartitions(*group, F.col("_moments").isNull(), "_cell")
    return ends.unionByName(rows.mapInArrow(_inside(cells, keys, names), schema))
