"""Merged regressions equal ``regr_slope`` over all rows, however they are split."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbline.operators.regression import event_sums, grid_slope, merged, regression_sums, slopes

POINT = st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.integers(-10 ** 6, 10 ** 6)),
                  st.integers(0, 2))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(POINT, min_size=1, max_size=40))
def test_parts_merge_to_the_whole(spark, points):
    df = spark.createDataFrame(points, "id string, x int, y bigint, part int")
    parts = [regression_sums(df.where(F.col("part") == k), "id", "x", "y") for k in range(3)]
    found = {r["id"]: r["slope"] for r in slopes(merged(parts, "id"), "id").collect()}
    want = {r["id"]: r["s"] for r in df.groupBy("id").agg(F.regr_slope(F.col("y").cast("double"), F.col("x").cast("double")).alias("s")).collect()}
    assert set(found) == set(want)
    for k, slope in want.items():
        assert found[k] == (None if slope is None else pytest.approx(slope, rel=1e-9, abs=1e-9))


def test_event_counts_over_a_grid(spark):
    periods = [2001, 2002, 2005]
    events = [("a", 2001)] * 3 + [("a", 2005)] * 10 + [("b", 2002), ("b", 1999), ("c", 1999), ("d", None)]
    df = spark.createDataFrame(events, "id string, year int").withColumn("k", F.pmod(F.monotonically_increasing_id(), F.lit(2)))
    sums = merged([event_sums(df.where(F.col("k") == k), "id", "year", periods) for k in (0, 1)], "id")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    found = {r["id"]: r["slope"] for r in ids.join(sums, "id", "left").select("id", grid_slope(periods).alias("slope")).collect()}

    def slope(counts):
        n, mean_x, mean_y = len(periods), sum(periods) / 3, sum(counts) / 3
        return sum((x - mean_x) * (y - mean_y) for x, y in zip(periods, counts)) / sum((x - mean_x) ** 2 for x in periods) if n else None

    assert found == {"a": pytest.approx(slope([3, 0, 10])), "b": pytest.approx(slope([0, 1, 0])), "c": 0.0}
    assert spark.range(1).select(F.lit(None).cast("decimal(38,0)").alias("sy"), F.lit(None).cast("decimal(38,0)").alias("sxy")).select(
        grid_slope([2001]).alias("s")).first()["s"] is None
