"""Mergeable least-squares regressions.

A regression of ``y`` on ``x`` per id is told by five sums (n, x, y, xy, xx). They add up: rows may be split over runs,
files or periods in any way, each part is reduced to one row per id, and ``merged`` parts give the slope of all rows.
Sums are exact decimals, so the order of merging changes nothing.

Counts of events are points (period, number of events) over a grid of periods, where a period without events is a zero.
Their ``y`` and ``xy`` are sums over events (1 and the period), so parts may share periods; n, x and xx follow from the
grid alone and come in at the end (``grid_slope``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = ("n", "sx", "sy", "sxy", "sxx")
_EXACT = "decimal(38,0)"


def regression_sums(points: DataFrame, id_col: str, x_col: str, y_col: str) -> DataFrame:
    """``id_col`` and the five sums of integer points; points with a NULL coordinate take no part, as in ``regr_slope``."""
    x, y = F.col(x_col).cast(_EXACT), F.col(y_col).cast(_EXACT)
    terms = (F.lit(1).cast(_EXACT), x, y, (x * y).cast(_EXACT), (x * x).cast(_EXACT))
    known = F.col(x_col).isNotNull() & F.col(y_col).isNotNull()
    return points.groupBy(id_col).agg(
        *[F.coalesce(F.sum(F.when(known, t)), F.lit(0)).cast(_EXACT).alias(s) for s, t in zip(SUMS, terms)])


def event_sums(events: DataFrame, id_col: str, period_col: str, periods: Sequence[int]) -> DataFrame:
    """``id_col``, ``sy``, ``sxy`` of the number of events per period of the grid (other events take no part)."""
    inside = events.where(F.col(period_col).isin(list(periods)))
    return inside.groupBy(id_col).agg(F.count(F.lit(1)).cast(_EXACT).alias("sy"),
                                      F.sum(F.col(period_col).cast(_EXACT)).cast(_EXACT).alias("sxy"))


def merged(parts: Sequence[DataFrame], id_col: str) -> DataFrame:
    """The sums of all parts, one row per id."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(id_col).agg(*[F.sum(c).cast(_EXACT).alias(c) for c in rows.columns if c != id_col])


def slope_of_sums(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column) -> Column:
    """``regr_slope`` from the sums: NULL without two different x."""
    below = (n * sxx - sx * sx).cast("double")
    return F.when(below != 0, (n * sxy - sx * sy).cast("double") / below)


def slopes(sums: DataFrame, id_col: str) -> DataFrame:
    return sums.select(id_col, slope_of_sums(*[F.col(s) for s in SUMS]).alias("slope"))


def grid_slope(periods: Sequence[int]) -> Column:
    """Slope of event counts over the whole grid, from their ``sy`` and ``sxy`` (NULL sums: no events)."""
    grid = (len(periods), sum(periods), sum(p * p for p in periods))
    n, sx, sxx = (F.lit(v).cast("decimal(20,0)") for v in grid)
    zero = F.lit(0).cast(_EXACT)
    sy, sxy = (F.coalesce(F.col(c), zero).cast("decimal(18,0)") for c in ("sy", "sxy"))
    return slope_of_sums(n, sx, sy, sxy, sxx)
