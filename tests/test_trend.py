import numpy as np
import pytest

from curbline.functions.trend import apply_rounding, centred_slope_expr, centred_weights, slope_expr

CASES = [((0, 0, 0, 0, 0), 0.0), ((1, 2, 3, 4, 5), 1.0), ((1, 0, 4, 2, 9), 1.8), ((5, 0, 0, 0, 0), -1.0),
         ((0, 0, 0, 1, 2), 0.5), ((0, 0, 0, 1, 7), 1.5)]


def frame(spark, rows):
    n = len(rows[0])
    return spark.createDataFrame(rows, ", ".join(f"c{i} bigint" for i in range(n))), [f"c{i}" for i in range(n)]


def test_closed_form(spark):
    df, cols = frame(spark, [c for c, _ in CASES])
    got = [r[0] for r in df.select(slope_expr(cols)).collect()]
    assert got == pytest.approx([e for _, e in CASES])


def test_rounding_modes(spark):
    df, cols = frame(spark, [c for c, _ in CASES])
    ints = [r[0] for r in df.select(apply_rounding(slope_expr(cols), "int_half_even")).collect()]
    assert ints == [0, 1, 2, -1, 0, 2] and all(isinstance(v, int) for v in ints)  # 0.5 -> 0, 1.5 -> 2
    two = [r[0] for r in df.select(apply_rounding(slope_expr(cols), "2dp")).collect()]
    assert two == [0.0, 1.0, 1.8, -1.0, 0.5, 1.5]


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 7])
def test_matches_least_squares(spark, n):
    rng = np.random.default_rng(n)
    rows = [tuple(int(v) for v in rng.integers(0, 50, n)) for _ in range(20)]
    df, cols = frame(spark, rows)
    got = [r for r in df.select(slope_expr(cols).alias("a"), centred_slope_expr(cols).alias("b")).collect()]
    x = np.arange(n)
    for row, (a, b) in zip(rows, got):
        want = np.polyfit(x, np.array(row, dtype=float), 1)[0]
        assert a == pytest.approx(want) and b == pytest.approx(want)


def test_weights():
    assert centred_weights(5) == ([-2, -1, 0, 1, 2], 10)
    assert centred_weights(4) == ([-3, -1, 1, 3], 10)
    assert centred_weights(5, [2015, 2016, 2017, 2018, 2019]) == ([-2, -1, 0, 1, 2], 10)


def test_uneven_years(spark):
    years = [2015, 2017, 2018, 2021]
    rows = [(3, 1, 4, 1), (0, 0, 0, 9), (5, 5, 5, 5)]
    df, cols = frame(spark, rows)
    got = [r[0] for r in df.select(slope_expr(cols, years)).collect()]
    for row, g in zip(rows, got):
        assert g == pytest.approx(np.polyfit(np.array(years, dtype=float), np.array(row, dtype=float), 1)[0])


def test_antisymmetric_and_constant(spark):
    df, cols = frame(spark, [(3, 1, 4, 1, 5), (5, 1, 4, 1, 3), (7, 7, 7, 7, 7)])
    s = [r[0] for r in df.select(slope_expr(cols)).collect()]
    assert s[0] == -s[1] and s[2] == 0.0
