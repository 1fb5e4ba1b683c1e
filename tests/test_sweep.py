"""The sweep against the join: sides of all widths, numbers of any length, runs that carry over, hot addresses."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, segments_df, tickets_df
from curbline.operators.segments import segment_sides
from curbline.operators.sweep import swept, sweep_counts
from curbline.operators.tickets import normalize_tickets
from curbline.plans.queries import QUERIES
from curbline.plans.report import segment_report
from curbline.policy import preset


def random_tables(spark, seed):
    rng = random.Random(seed)

    def number():
        return str(rng.choice([rng.randrange(40), rng.randrange(30_000), rng.randrange(10 ** 17), 10 ** 20 + rng.randrange(5)]))

    t = [(f"T{k}", f"01/01/{rng.choice([2015, 2016, 2019])}", "NY", rng.choice([number(), f"{number()}-{rng.randrange(9)}"]), "A ST")
         for k in range(60)] + [(f"H{k}", "01/01/2016", "NY", "25", "A ST") for k in range(30)]
    s = []
    for k in range(25):
        ends = [number() for _ in range(4)]
        low, high = sorted(ends[:2], key=int)
        s.append((f"S{k}", low, high, *(ends[2:] if k % 3 else (f"{ends[2]}-1", f"{ends[3]}-7")), "A ST", "1", "A ST", ""))
    return tickets_df(spark, t), segments_df(spark, s + s[:2])


@pytest.mark.parametrize("name", ["canonical", "four_branch", "side_unpivot"])
def test_sweep_equals_join(spark, name):
    t, s = random_tables(spark, 3)
    pol = preset(name, fold_case=True)
    want = sorted(map(tuple, segment_report(t, s, pol).collect()))
    assert sorted(map(tuple, segment_report(t, s, pol.with_(range_join="sweep")).collect())) == want
    assert any(any(r[1:6]) for r in want)


def test_runs_carry_over(spark):
    t, s = random_tables(spark, 5)
    pol = preset("canonical")
    tickets, sides = normalize_tickets(t, pol).where("hn_suffix is null"), segment_sides(s, pol)
    probes = tickets.withColumn("is_left", F.col("hn") % 2 == 1)
    want = sorted(map(tuple, swept(probes, sides, pol.years, 10 ** 18).collect()))
    assert sorted(map(tuple, swept(probes, sides, pol.years, 7).collect())) == want


def test_plan_has_no_pairs_of_plain_tickets(spark):
    """Window and sorts only: no generated rows per block, no nested loop."""
    pol = preset("canonical")
    t, s = random_tables(spark, 1)
    sides = spark.createDataFrame(segment_sides(s, pol).collect(), segment_sides(s, pol).schema)
    probes = normalize_tickets(t, pol).withColumn("is_left", F.col("hn") % 2 == 1)
    plan = swept(spark.createDataFrame(probes.collect(), probes.schema), sides, pol.years)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_dedup_is_refused(spark):
    with pytest.raises(ValueError):
        preset("row_predicate", range_join="sweep")
    with pytest.raises(ValueError):
        sweep_counts(None, None, preset("row_predicate"))


def test_sorted_files_are_in_order(spark):
    rows = sorted((r["position"], r["segment_id"]) for r in QUERIES["report_sorted_files"](spark, SF_SMALL).collect())
    assert [p for p, _ in rows] == list(range(1, len(rows) + 1))
    assert [i for _, i in rows] == sorted(i for _, i in rows)


def test_tickets_are_read_once(spark):
    """The sweep and the join of what it leaves share one sum of the tickets per address."""
    pol = preset("canonical", range_join="sweep", broadcast_max_bytes=0)
    t, s = random_tables(spark, 3)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = t.count()
    watched = t.mapInArrow(counted, t.schema)
    segment_report(watched, s, pol).collect()
    assert seen.value == rows
