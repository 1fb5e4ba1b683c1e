"""A hot address holding a third of all tickets: exact results on every path,
and the shuffle path combines it before the join."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from curbline.operators.matching import (
    _is_hot,
    hot_streets,
    match_pairs,
    salted_probes,
    salted_sides,
    ticket_probes,
)
from curbline.operators.segments import explode_blocks, level_map, level_widths, segment_sides, with_levels
from curbline.operators.tickets import normalize_tickets
from curbline.plans.queries import fixture_policy
from curbline.plans.report import segment_report
from curbline.sources.fixtures import fixture_segments, fixture_tickets


def hot_tickets(spark):
    t = fixture_tickets(spark, SF_SMALL)
    n = t.count()
    row = t.where(F.col("house_number").rlike("^[0-9]+$") & (F.col("county") == "NY")
                  & F.col("issue_date").endswith("1996")).orderBy("ticket_id").first()
    # the same address and year repeated n/2 times: a third of all rows
    hot = spark.range(n // 2).select(
        F.concat(F.lit("H"), F.col("id").cast("string")).alias("ticket_id"),
        *[F.lit(row[c]).alias(c) for c in ("issue_date", "county", "house_number", "street_name")])
    return t.unionByName(hot)


def test_hot_address_all_paths_agree(spark):
    t, s = hot_tickets(spark), fixture_segments(spark, SF_SMALL)
    want = sorted(map(tuple, segment_report(t, s, fixture_policy()).collect()))
    for overrides in ({"broadcast_max_bytes": 0}, {"bin_width": None}, {"preaggregate": "always"},
                      {"broadcast_max_bytes": 0, "preaggregate": "never", "skew_salt": 5}):
        got = sorted(map(tuple, segment_report(t, s, fixture_policy(**overrides)).collect()))
        assert got == want, overrides
    for dedup in ("id_ticket", "id_ticket_year"):
        want = sorted(map(tuple, segment_report(t, s, fixture_policy(dedup=dedup)).collect()))
        for salt in (1, 7):
            pol = fixture_policy(dedup=dedup, broadcast_max_bytes=0, skew_salt=salt)
            assert sorted(map(tuple, segment_report(t, s, pol).collect())) == want, (dedup, salt)


def test_only_hot_streets_are_salted(spark):
    """The counting pass finds the street that holds a third of the tickets; only its sides are replicated."""
    pol = fixture_policy(dedup="id_ticket_year", broadcast_max_bytes=0, skew_salt=8, hot_keys=8)
    t, s = hot_tickets(spark), fixture_segments(spark, SF_SMALL)
    probes, sides = ticket_probes(normalize_tickets(t, pol), pol), segment_sides(s, pol)
    counts = probes.groupBy("boro", "street").count()
    total = probes.count()
    want = {(r["boro"], r["street"]) for r in counts.collect() if r["count"] * 8 > total}
    hot = hot_streets(probes, pol)
    assert set(hot) == want and len(want) == 1
    is_hot = _is_hot(hot)
    copies = {(r["boro"], r["street"]): r["n"] for r in salted_sides(sides, is_hot, 8).groupBy("boro", "street").agg(
        (F.countDistinct("salt")).alias("n")).collect()}
    assert {k for k, n in copies.items() if n == 8} == {k for k in want if k in copies}
    assert {n for k, n in copies.items() if k not in want} == {1}
    salts = salted_probes(probes, is_hot, 8).groupBy(is_hot.alias("hot")).agg(F.countDistinct("salt").alias("n")).collect()
    assert {r["hot"]: r["n"] for r in salts} == {True: 8, False: 1}


def test_hot_streets_of_no_tickets(spark):
    pol = fixture_policy()
    assert hot_streets(spark.createDataFrame([], "boro int, street string"), pol) == []
    assert hot_streets(spark.createDataFrame([(None, None), (1, None), (1, "a|b")], "boro int, street string"), pol) == [(1, "a|b")]


def test_tickets_without_ids_are_dealt_by_address(spark):
    """A third of the tickets have no id (NULL or empty); they count once per segment like any id, in many tasks."""
    t, s = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    blank = t.withColumn("ticket_id", F.when(F.pmod(F.hash("ticket_id"), F.lit(6)) == 0, F.lit(None))
                         .when(F.pmod(F.hash("ticket_id"), F.lit(6)) == 1, F.lit("")).otherwise(F.col("ticket_id")))
    # the same rows under two ids that are not blank
    marked = blank.withColumn("ticket_id", F.coalesce(F.when(F.col("ticket_id") == "", "B").otherwise(F.col("ticket_id")), F.lit("N")))
    for dedup, paths in (("id_ticket", ({}, {"broadcast_max_bytes": 0})), ("id_ticket_year", ({},)), ("id_ticket_year_side", ({},))):
        want = sorted(map(tuple, segment_report(marked, s, fixture_policy(dedup=dedup)).collect()))
        for more in paths:
            got = segment_report(blank, s, fixture_policy(dedup=dedup, **more)).collect()
            assert sorted(map(tuple, got)) == want, (dedup, more)
    pol = fixture_policy(dedup="id_ticket")
    spread = match_pairs(normalize_tickets(blank, pol), segment_sides(s, pol), pol).where("coalesce(ticket_id, '') = ''")
    assert spread.select("spread").distinct().count() > 20


def test_one_wide_side_costs_only_its_street_another_probe(spark):
    """Each probe looks up one block per level that its street has; a street without sides ends the probe."""
    seg = "segment_id string, boro int, street string, is_left boolean, lo bigint, hi bigint"
    sides = spark.createDataFrame([("S1", 1, "a", True, 1, 99), ("S2", 1, "a", True, 5, 900_000), ("S3", 1, "b", True, 1, 50),
                                   ("S4", 1, "b", False, 80, 120)], seg)
    widths = level_widths(100, 16)
    placed = with_levels(sides, widths)
    assert {r["segment_id"]: r["level"] for r in placed.collect()} == {"S1": 0, "S2": 4, "S3": 0, "S4": 0}
    assert {r["street"]: sorted(r["levels"]) for r in level_map(placed).collect()} == {"a": [0, 4], "b": [0]}
    entries = explode_blocks(placed.withColumns({c: F.lit(None) for c in ("lo_c", "hi_c", "o_lo_c", "o_hi_c", "long")}))
    assert {r["segment_id"]: r["count"] for r in entries.groupBy("segment_id").count().collect()} == {"S1": 1, "S2": 1, "S3": 1, "S4": 2}
    assert widths[-1] > 10 ** 18 and widths[-2] <= 10 ** 18


def test_salted_join_spreads_a_hot_address(spark):
    from curbline.operators.counting import dedup_matches
    t, s = hot_tickets(spark), fixture_segments(spark, SF_SMALL)
    pol = fixture_policy(dedup="id_ticket_year", broadcast_max_bytes=0, skew_salt=8)
    matched = match_pairs(normalize_tickets(t, pol), segment_sides(s, pol), pol)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "salt" in plan.split("SortMergeJoin", 1)[1].split("\n", 1)[0]
    assert dedup_matches(matched, pol).count() > 0


def test_hot_address_collapses_before_shuffle(spark):
    pol = fixture_policy(broadcast_max_bytes=0)
    t, s = hot_tickets(spark), fixture_segments(spark, SF_SMALL)
    norm = normalize_tickets(t, pol)
    probes = ticket_probes(norm, pol)
    keys = ["boro", "street", "is_left", "hn", "hn_suffix", "kind", "year"]
    distinct_probes = probes.select(*keys).distinct().count()
    assert distinct_probes < norm.count() * 2 // 3  # the hot third collapses to one probe
    matched = match_pairs(norm, segment_sides(s, pol), pol)
    # multiplicities carry the hot address: the sum of n equals the streamed path's row count
    streamed = match_pairs(norm, segment_sides(s, pol), fixture_policy(preaggregate="never"))
    assert matched.agg(F.sum("n")).first()[0] == streamed.agg(F.sum("n")).first()[0]
