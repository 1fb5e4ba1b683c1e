"""Golden match table: matches of one ticket against one segment, per preset.

Street and borough are equal in every case, so only the house-number rules
decide. Columns follow the presets four_branch, split_union, either_side,
row_predicate, distinct_ticket, side_unpivot.
"""

import pytest

from conftest import segments_df, tickets_df
from curbline.plans.report import segment_counts
from curbline.policy import preset

PRESET_ORDER = ("four_branch", "split_union", "either_side", "row_predicate", "distinct_ticket", "side_unpivot")

# house, left low..high, right low..high, expected per preset
GOLDEN = [
    ("125", "101", "199", "100", "198", (1, 1, 1, 1, 1, 1)),
    ("126", "101", "199", "100", "198", (1, 1, 1, 1, 1, 1)),
    ("101", "101", "199", "100", "198", (1, 1, 1, 1, 1, 1)),
    ("201", "101", "199", "100", "198", (0, 0, 0, 0, 0, 0)),
    ("70-23", "70-01", "70-99", "70-02", "70-98", (2, 1, 1, 1, 1, 1)),
    ("70-24", "70-01", "70-99", "70-02", "70-98", (2, 1, 1, 1, 1, 1)),
    ("71-23", "71-01", "71-99", "71-02", "71-98", (2, 1, 1, 1, 1, 1)),
    ("71-24", "71-01", "71-99", "71-02", "71-98", (2, 1, 1, 1, 1, 1)),
    ("71-24", "71-25", "71-99", "71-02", "71-98", (2, 0, 1, 0, 0, 0)),
    ("71", "71-01", "71-99", "71-02", "71-98", (1, 1, 1, 1, 1, 0)),
    ("125-3", "101", "199", "100", "198", (1, 0, 0, 0, 0, 0)),
    ("71-", "71-01", "71-99", "71-02", "71-98", (1, 1, 1, 1, 1, 0)),
    ("71-100", "71-01", "71-99", "71-02", "71-98", (1, 0, 0, 1, 0, 0)),
    ("11-13", "11-01", "12-09", "11-02", "12-08", (1, 0, 0, 0, 0, 0)),
    ("12A", "1", "99", "2", "98", (0, 0, 0, 0, 0, 0)),
    ("ABC", "1", "99", "2", "98", (0, 0, 0, 0, 0, 0)),
    # strict ASCII digits: a leading space or sign is not a number here (the
    # lenient casts of four of the variants would count these once)
    (" 25", "1", "99", "2", "98", (0, 0, 0, 0, 0, 0)),
    ("+25", "1", "99", "2", "98", (0, 0, 0, 0, 0, 0)),
    ("25-3-1", "25-1", "25-9", "25-2", "25-8", (2, 1, 1, 0, 1, 1)),
    ("25", "1", "", "2", "98", (0, 0, 0, 0, 0, 0)),
    ("25", "1", "99-9", "2", "98", (1, 0, 0, 0, 0, 1)),
    ("71-05", "71-01", "71-99", "", "", (2, 1, 1, 1, 1, 1)),
    ("0", "1", "99", "0", "98", (1, 1, 1, 1, 1, 1)),
]


@pytest.fixture(scope="module")
def golden_frames(spark):
    tickets, segments = [], []
    for i, (house, ll, lh, rl, rh, _) in enumerate(GOLDEN):
        street = f"MAIN ST {i}"
        tickets.append((f"T{i}", "06/14/2015", "NY", house, street))
        segments.append((f"S{i:02d}", ll, lh, rl, rh, street, "1", street, street))
    return tickets_df(spark, tickets), segments_df(spark, segments)


@pytest.mark.parametrize("preset_name", PRESET_ORDER)
def test_golden_table(golden_frames, preset_name):
    tickets, segments = golden_frames
    counts = segment_counts(tickets, segments, preset(preset_name))
    got = {r["segment_id"]: r["n"] for r in counts.groupBy("segment_id").sum("n")
           .withColumnRenamed("sum(n)", "n").collect()}
    col = PRESET_ORDER.index(preset_name)
    for i, case in enumerate(GOLDEN):
        assert got.get(f"S{i:02d}", 0) == case[5][col], (preset_name, case)


@pytest.mark.parametrize("bin_width,bcast", [(None, True), (1, True), (10, False), (None, False)])
def test_golden_independent_of_physical_plan(golden_frames, bin_width, bcast):
    """Blocks, broadcast or shuffle join: the same matches."""
    tickets, segments = golden_frames
    for name in PRESET_ORDER:
        pol = preset(name, bin_width=bin_width, broadcast_max_bytes=(1 << 40) if bcast else 0)
        counts = segment_counts(tickets, segments, pol)
        got = {r[0]: r[1] for r in counts.groupBy("segment_id").sum("n").collect()}
        col = PRESET_ORDER.index(name)
        for i, case in enumerate(GOLDEN):
            assert got.get(f"S{i:02d}", 0) == case[5][col], (name, bin_width, bcast, case)


def test_wide_ranges_sit_at_their_level(spark):
    """A side spanning thousands of blocks is matched exactly, as is its narrow other side."""
    tickets = tickets_df(spark, [("T1", "01/01/2016", "NY", "5001", "WIDE ST"),
                                 ("T2", "01/01/2016", "NY", "7", "WIDE ST")])
    segments = segments_df(spark, [("S1", "1", "99999", "2", "8", "WIDE ST", "1", "WIDE ST", "")])
    pol = preset("canonical", bin_width=10, level_step=4)
    rows = segment_counts(tickets, segments, pol).collect()
    assert sorted((r["segment_id"], r["year"], r["n"]) for r in rows) == [("S1", 2016, 1), ("S1", 2016, 1)]


def test_per_id_year_shape(spark):
    """The pivot keyed by (segment, year): one row per (segment, year with
    matches) holding only that year's count, the slope computed on that row;
    a segment without matches keeps one zero row."""
    from curbline.plans.report import segment_report
    tickets = tickets_df(spark, [("1", "01/01/2015", "NY", "125", "A ST"), ("2", "02/01/2015", "NY", "127", "A ST"),
                                 ("3", "03/01/2017", "NY", "131", "A ST")])
    segments = segments_df(spark, [("S1", "101", "199", "100", "198", "A ST", "1", "A ST", "A ST"),
                                   ("S2", "1", "99", "2", "98", "B ST", "1", "B ST", "B ST")])
    rows = sorted(tuple(r) for r in segment_report(tickets, segments, preset("split_union")).collect())
    assert rows == [("S1", 0, 0, 1, 0, 0, 0.0), ("S1", 2, 0, 0, 0, 0, -0.4), ("S2", 0, 0, 0, 0, 0, 0.0)]
    per_id = sorted(tuple(r) for r in segment_report(tickets, segments, preset("split_union", group="per_id")).collect())
    assert per_id == [("S1", 2, 0, 1, 0, 0, -0.4), ("S2", 0, 0, 0, 0, 0, 0.0)]


def _total(spark, tickets, segments, pol):
    rows = segment_counts(tickets, segments, pol).collect()
    return sum(r["n"] for r in rows)


def test_case_folding_and_street_keys(spark):
    """fold_case decides whether 'Broadway' meets 'BROADWAY'; the street key
    decides which segment names a ticket street may equal."""
    tickets = tickets_df(spark, [("1", "01/01/2016", "NY", "125", "Broadway"),
                                 ("2", "01/01/2016", "NY", "125", "ALT NAME"),
                                 ("3", "01/01/2016", "NY", "125", "THIRD NAME")])
    # full name BROADWAY, label ALT NAME (position 10), second label THIRD NAME (position 29)
    segments = segments_df(spark, [("S1", "101", "199", "100", "198", "ALT NAME", "1", "BROADWAY", "THIRD NAME")])
    assert _total(spark, tickets, segments, preset("four_branch")) == 0  # case-sensitive, full name present
    assert _total(spark, tickets, segments, preset("four_branch", fold_case=True)) == 1
    assert _total(spark, tickets, segments, preset("canonical", street_key="full")) == 1
    assert _total(spark, tickets, segments, preset("canonical")) == 2  # full OR label (position 10)
    assert _total(spark, tickets, segments, preset("split_union")) == 2  # full OR second label (position 29)
    empty_full = segments_df(spark, [("S1", "101", "199", "100", "198", "ALT NAME", "1", "", "")])
    assert _total(spark, tickets, empty_full, preset("canonical", street_key="coalesce")) == 1  # label stands in


def test_dedup_modes(spark):
    """One ticket id on three rows (twice in 2015, once in 2016), all on S1."""
    tickets = tickets_df(spark, [("T", "01/01/2015", "NY", "125", "A ST"), ("T", "05/01/2015", "NY", "127", "A ST"),
                                 ("T", "01/01/2016", "NY", "125", "A ST")])
    segments = segments_df(spark, [("S1", "101", "199", "100", "198", "A ST", "1", "A ST", "A ST")])

    def per_year(pol):
        rows = segment_counts(tickets, segments, pol).groupBy("year").sum("n").collect()
        return dict(sorted((r[0], r[1]) for r in rows))

    assert per_year(preset("canonical")) == {2015: 2, 2016: 1}  # every match counts
    assert per_year(preset("canonical", dedup="id_ticket_year")) == {2015: 1, 2016: 1}
    assert per_year(preset("canonical", dedup="id_ticket")) == {2015: 1}  # once, in its earliest year


def test_left_parsed_spine(spark):
    """side_unpivot's spine holds segments whose LEFT range parses; a segment
    with an unparseable left range still appears when its right side matches."""
    from curbline.plans.report import segment_report
    tickets = tickets_df(spark, [("1", "01/01/2016", "NY", "126", "B ST")])
    segments = segments_df(spark, [
        ("S1", "101", "199", "100", "198", "A ST", "1", "A ST", ""),   # parsed left, no match: zero row
        ("S2", "", "", "100", "198", "B ST", "1", "B ST", ""),         # no left range, right match: counted
        ("S3", "x", "", "100", "198", "C ST", "1", "C ST", ""),        # no left range, no match: absent
    ])
    ids = sorted(r["segment_id"] for r in segment_report(tickets, segments, preset("side_unpivot")).collect())
    assert ids == ["S1", "S2"]
    assert sorted(r["segment_id"] for r in segment_report(tickets, segments, preset("canonical")).collect()) == [
        "S1", "S2", "S3"]


def test_dedup_per_side(spark):
    """One ticket id on an odd and an even number of one segment and year: a match on each side."""
    tickets = tickets_df(spark, [("T", "01/01/2016", "NY", "125", "A ST"), ("T", "02/01/2016", "NY", "126", "A ST"),
                                 ("T", "03/01/2016", "NY", "128", "A ST")])
    segments = segments_df(spark, [("S1", "101", "199", "100", "198", "A ST", "1", "A ST", "A ST")])
    assert _total(spark, tickets, segments, preset("distinct_ticket")) == 2
    assert _total(spark, tickets, segments, preset("canonical", dedup="id_ticket_year")) == 1


def test_house_numbers_of_any_length(spark):
    segments = segments_df(spark, [("S1", "1", "9", "1", "9", "A ST", "1", "A ST", ""),
                                   ("S2", "1" + "0" * 24, "2" + "0" * 24, "", "", "B ST", "1", "B ST", ""),
                                   ("S3", "1", "9" * 22, "", "", "C ST", "1", "C ST", ""),
                                   ("S4", "1", "9", "1", "9", "A ST", "99999999999", "A ST", "")])
    tickets = tickets_df(spark, [("1", "01/01/2016", "NY", "0" * 25 + "5", "A ST"),
                                 ("2", "01/01/2016", "NY", "1" + "0" * 23 + "1", "B ST"),   # inside
                                 ("3", "01/01/2016", "NY", "2" + "0" * 23 + "1", "B ST"),   # one too many
                                 ("4", "01/01/2016", "NY", "1" + "0" * 23 + "2", "B ST"),   # even: no right side
                                 ("5", "01/01/2016", "NY", "9" * 21, "C ST"),
                                 ("6", "01/01/2016", "NY", "77", "C ST")])
    for pol in (preset("canonical"), preset("canonical", broadcast_max_bytes=0)):
        rows = segment_counts(tickets, segments, pol).groupBy("segment_id").sum("n").collect()
        assert {r[0]: r[1] for r in rows} == {"S1": 1, "S2": 1, "S3": 2}
