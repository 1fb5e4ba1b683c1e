"""Tickets counted once per segment: against a plain version, and without a shuffle by segment and ticket."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import segments_df, tickets_df
from curbline.operators import once
from curbline.operators.counting import dedup_matches
from curbline.operators.matching import match_pairs
from curbline.operators.segments import segment_sides
from curbline.operators.tickets import normalize_tickets
from curbline.plans.report import segment_counts
from curbline.policy import preset


def odd_tables(spark, seed):
    """Ids in many rows, without text or NULL; segments in several rows, on two streets, and in two boroughs."""
    rng = random.Random(seed)
    streets = ["A ST", "B ST", "C ST", "Z ST"]
    numbers = [str(n) for n in range(8)] + ["3-1", "4-2", "5-7", "10000000000000000000001"]
    t = [(rng.choice([None, "", "X", *[f"T{k}" for k in range(40)]]), f"01/01/{rng.choice([2015, 2016, 2019])}",
          rng.choice(["NY", "NY", "K"]), rng.choice(numbers), rng.choice(streets)) for _ in range(300)]
    s = []
    for k in range(30):
        low = rng.randrange(5)
        more = rng.choice(["", "", "-1"])
        one, two = rng.choice(streets[:3]), rng.choice([*streets[:3], "none"])
        s.append((f"S{k % 22}", f"{low}{more}", f"{low + 4}{more and '-9'}", "2", rng.choice(["6", "10000000000000000000009"]),
                  two, rng.choice(["1", "1", "3"]), one, two))
    return tickets_df(spark, t + t[:20]), segments_df(spark, s + s[:3])


def counts(df):
    return sorted(map(tuple, df.groupBy("segment_id", "year").agg(F.sum("n")).where("sum(n) > 0").collect()))


@pytest.mark.parametrize("dedup", ["id_ticket", "id_ticket_year", "id_ticket_year_side"])
@pytest.mark.parametrize("most,overrides", [(16, {}), (2, {"broadcast_max_bytes": 0}), (16, {"bin_width": None, "compound": "four_branch"})])
def test_once_equals_distinct_pairs(spark, monkeypatch, dedup, most, overrides):
    monkeypatch.setattr(once, "MOST", most)
    t, s = odd_tables(spark, 7)
    pol = preset("canonical", dedup=dedup, **overrides)
    pairs = match_pairs(normalize_tickets(t, pol), segment_sides(s, pol), pol)
    want = counts(dedup_matches(pairs, pol))
    assert counts(segment_counts(t, s, pol)) == want and len(want) > 20


def test_matches_are_not_shuffled(spark):
    """1,000 tickets on a street of 300 segments: no exchange carries their 300,000 matches."""
    t = tickets_df(spark, [(f"T{k}", "01/01/2015", "NY", "25", "A ST") for k in range(1_000)])
    s = segments_df(spark, [(f"S{k}", "1", "99", "2", "98", "A ST", "1", "A ST", "") for k in range(300)])
    for name in ("row_predicate", "distinct_ticket"):
        found = segment_counts(t, s, preset(name, broadcast_max_bytes=0))
        assert {r["n"] for r in found.collect()} == {1_000}
        plan = found._jdf.queryExecution().executedPlan()
        rows, todo = [], [plan]
        while todo:
            node = todo.pop()
            if "AdaptiveSparkPlanExec" in node.getClass().getName():
                todo.append(node.executedPlan())
                continue
            if "QueryStageExec" in node.getClass().getName():
                todo.append(node.plan())
                continue
            written = node.metrics().get("shuffleRecordsWritten")
            if written.isDefined():
                rows.append(written.get().value())
            todo += [node.children().apply(k) for k in range(node.children().size())]
        assert rows and max(rows) <= 1_000
