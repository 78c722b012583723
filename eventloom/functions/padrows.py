"""Found and findable pad rows of a track, from its array of row hits.

``hits`` is an array of booleans, one per pad row (at most a few hundred).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any(hits: Column, first: Column, final: Column) -> Column:
    """A hit in the closed range of rows, clipped to the array."""
    lo = F.greatest(first, F.lit(0))
    hi = F.least(final, F.size(hits) - 1)
    part = F.slice(hits, lo + 1, F.greatest(hi - lo + 1, F.lit(0)))
    return F.exists(part, lambda h: h)


def _rows(hits: Column, first: int, end: int) -> Column:
    last = F.least(F.size(hits), F.lit(end)) - 1
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def _count(rows: Column, test) -> Column:
    return F.size(F.filter(rows, test))


def found_rows(hits: Column, first: int, end: int) -> Column:
    return _count(_rows(hits, first, end), lambda i: F.get(hits, i))


def findable_rows(hits: Column, neighbours: int, first: int, end: int, both_sides: bool = False) -> Column:
    """Rows in [first, end) that are hit or near a hit.

    Near: a hit up to ``neighbours`` rows back (not before ``first``) or ahead (also past
    ``end``); with ``both_sides`` one on either side.  Row 0 counts as having a hit before.
    """
    def findable(i: Column) -> Column:
        before = (i <= 0) | _any(hits, F.greatest(i - neighbours, F.lit(first)), i - 1)
        after = _any(hits, i + 1, i + neighbours)
        return F.get(hits, i) | ((before & after) if both_sides else (before | after))

    return _count(_rows(hits, first, end), findable)


def crossed_rows(hits: Column) -> Column:
    """Findable rows with two neighbours over the whole track."""
    return findable_rows(hits, 2, 0, 159)


def row_fraction(found: Column, findable: Column) -> Column:
    return F.when(findable > 0, found / findable).otherwise(F.lit(0.0))


def density_rows(hits: Column, neighbours: int, first: int, end: int) -> tuple[Column, Column]:
    """(findable, found): rows with a hit within ``neighbours`` rows below and above, and those also hit.

    Looking down may leave the range, looking up may not.
    """
    last = F.least(F.size(hits), F.lit(end)) - 1

    def between(i: Column) -> Column:
        return _any(hits, i - neighbours, i - 1) & _any(hits, i + 1, F.least(i + neighbours, last))

    rows = _rows(hits, first, end)
    return _count(rows, between), _count(rows, lambda i: between(i) & F.get(hits, i))


def good_density(index: Column, first: int, last: int) -> Column:
    """Rows found over rows outside dead zones, 0.5 when at most half the range is usable.

    ``index`` holds -1 for a dead row, 0 for an empty one, above 0 for a cluster.
    """
    part = F.slice(index, first + 1, last - first + 1)
    good = F.size(F.filter(part, lambda v: v != -1))
    found = F.size(F.filter(part, lambda v: v > 0))
    return F.when(good > max((last - first) * 0.5, 0.0), found / good).otherwise(F.lit(0.5))
