"""The planning totals of FIXTURES.md section 4 (computed independently with
DuckDB while the fixture was specified) reproduced by the engine at sf0.001."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from curbline.operators.tickets import normalize_tickets
from curbline.plans.queries import fixture_policy
from curbline.plans.report import segment_counts
from curbline.sources.fixtures import fixture_segments, fixture_tickets

RULES = {
    "split_union": dict(compound="same_side", segment_split="pairwise"),
    "either_side": dict(compound="either_side", segment_split="pairwise"),
    "four_branch": dict(compound="four_branch", segment_split="each"),
    "side_unpivot": dict(compound="zero_default", segment_split="strict_zero", ticket_split="strict_tuple"),
}
# street key -> (split_union, either_side, four_branch, side_unpivot, segments hit by split_union)
EXPECTED = {
    "full": (309, 310, 355, 233, 116),
    "coalesce": (352, 353, 402, 267, 133),
    "either": (416, 418, 469, 315, 156),
}


@pytest.fixture(scope="module")
def frames(spark):
    return fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)


def test_ticket_totals(frames):
    t, _ = frames
    n = normalize_tickets(t, fixture_policy(), drop_unparsed=False)
    row = n.agg(F.count(F.lit(1)), F.count("hn"), F.count(F.when(F.col("hn").isNotNull(), F.col("hn_suffix")))).first()
    assert tuple(row) == (3691, 2826, 350)


@pytest.mark.parametrize("key", sorted(EXPECTED))
def test_match_totals(frames, key):
    t, s = frames
    got = []
    for name, kw in RULES.items():
        pol = fixture_policy("canonical", street_key=key, label_column="street_label", **kw)
        got.append(segment_counts(t, s, pol).agg(F.sum("n")).first()[0])
    hit = segment_counts(t, s, fixture_policy("canonical", street_key=key)).select("segment_id").distinct().count()
    assert tuple(got) + (hit,) == EXPECTED[key]
