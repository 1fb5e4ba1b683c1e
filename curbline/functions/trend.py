"""Least-squares trend of a short, evenly spaced yearly series.

With x centred on zero (x = -2..2 for five years) the slope of an OLS fit is
the same with or without an intercept: sum(x*y) / sum(x*x). It is computed as
one integer-weighted column expression, so it is exact up to the final
division and identical in every engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def centred_weights(n: int, xs: Sequence[int] | None = None) -> tuple[list[int], float]:
    """Integer weights w_i and a divisor d with slope = sum(w_i * y_i) / d.

    ``xs`` are the period positions (default 0..n-1; the report passes the
    years, so a window with gaps is fitted on the real years). With S = sum(x),
    n*x_i - S are integers proportional to x_i - mean(x); reduced by their gcd g
    they give w_i, and slope = sum((x_i - mean) y_i) / sum((x_i - mean)^2)
    = sum(w_i y_i) / (g * sum(w_i^2) / n). Five consecutive periods give
    w = (-2, -1, 0, 1, 2), d = 10.
    """
    if n < 2:
        raise ValueError("a slope needs at least two periods")
    xs = list(range(n)) if xs is None else [int(x) for x in xs]
    if len(xs) != n or len(set(xs)) < 2:
        raise ValueError("need one position per period, not all equal")
    total = sum(xs)
    scaled = [n * x - total for x in xs]
    g = 0
    for v in scaled:
        g = math.gcd(g, v)
    w = [v // g for v in scaled]
    divisor = g * sum(v * v for v in w) / n
    return w, int(divisor) if float(divisor).is_integer() else divisor


def slope_expr(cols: Sequence[Column | str], xs: Sequence[int] | None = None) -> Column:
    """Closed-form OLS slope of the columns against positions ``xs``
    (default: consecutive periods)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    weights, divisor = centred_weights(len(cols), xs)
    numerator = None
    for w, c in zip(weights, cols):
        if w == 0:
            continue
        term = c * F.lit(w)
        numerator = term if numerator is None else numerator + term
    return numerator.cast("double") / F.lit(float(divisor))


def centred_slope_expr(cols: Sequence[Column | str]) -> Column:
    """The slope written as sum(x_i * (y_i - mean)) / sum(x_i^2), in doubles.

    Equal to ``slope_expr`` in exact arithmetic; kept for callers that want the
    mean-centred form.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    n = len(cols)
    if n < 2:
        raise ValueError("a slope needs at least two periods")
    xs = [i - (n - 1) / 2.0 for i in range(n)]
    mean = sum(cols[1:], cols[0]) / F.lit(float(n))
    acc = None
    for x, c in zip(xs, cols):
        term = F.lit(x) * (c - mean)
        acc = term if acc is None else acc + term
    return acc / F.lit(sum(x * x for x in xs))


def row_mean_expr(cols: Sequence[Column | str]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return sum(cols[1:], cols[0]).cast("double") / F.lit(float(len(cols)))


def apply_rounding(c: Column, mode: str) -> Column:
    """``none``; ``int_half_even`` (banker's rounding to an integer, BIGINT, so
    a text sink writes ``3`` like an integer result would); ``2dp`` (DOUBLE)."""
    if mode == "none":
        return c
    if mode == "int_half_even":
        return F.bround(c, 0).cast("bigint")
    if mode == "2dp":
        return F.bround(c, 2)
    raise ValueError(f"unknown rounding mode {mode!r}")
