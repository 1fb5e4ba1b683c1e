"""Physical plan shape: hash joins only, no Python, pruned scans."""

import re

from conftest import SF_SMALL
from curbline.plans.queries import QUERIES, fixture_policy
from curbline.plans.report import segment_report
from curbline.sources.fixtures import fixture_segments, fixture_tickets


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_plan_uses_hash_joins_without_python(spark):
    for name in ("match_canonical", "match_four_branch", "match_row_predicate", "match_side_unpivot"):
        plan = plan_text(QUERIES[name](spark, SF_SMALL))
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
        assert "BroadcastHashJoin" in plan, name


def test_shuffle_join_path_preaggregates(spark):
    t, s = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    pol = fixture_policy(broadcast_max_bytes=0)
    df = segment_report(t, s, pol)
    plan = plan_text(df)
    assert "SortMergeJoin" in plan
    join_part = plan[plan.index("SortMergeJoin"):]
    assert "functions=[partial_count(1)]" in join_part  # probes combined before the shuffle
    # same numbers as the broadcast plan
    want = sorted(tuple(r) for r in segment_report(t, s, fixture_policy()).collect())
    assert sorted(tuple(r) for r in df.collect()) == want


def test_scan_is_pruned(spark):
    df = QUERIES["match_canonical"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan


def test_wide_sides_keep_one_ticket_scan(spark):
    """Sides of all lengths share the join (each at its level): the tickets are scanned once, and the result equals the
    default plan's."""
    t, s = fixture_tickets(spark, SF_SMALL), fixture_segments(spark, SF_SMALL)
    pol = fixture_policy(bin_width=2, level_step=2)  # sides sit at several levels
    df = segment_report(t, s, pol)
    plan = plan_text(df)
    assert plan.count("FileScan parquet [l_orderkey") == 1
    want = sorted(tuple(r) for r in segment_report(t, s, fixture_policy()).collect())
    assert sorted(tuple(r) for r in df.collect()) == want


def test_generated_methods_stay_compilable(spark):
    """The JVM never compiles a method of more than 8,000 bytes: no report query generates one."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else stages are generated only when they run
    debug = getattr(spark._jvm.org.apache.spark.sql.execution, "debug")
    try:
        sizes = {}
        for name, q in QUERIES.items():
            plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan()
            stages = getattr(debug, "package$").__getattr__("MODULE$").codegenStringSeq(plan)
            sizes[name] = max([stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())], default=0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert {n: s for n, s in sizes.items() if s > 8000} == {}
    assert max(sizes.values()) > 1000  # the sizes were really read


def test_no_registered_query_has_nested_loops_or_python(spark):
    for name, q in sorted(QUERIES.items()):
        plan = plan_text(q(spark, SF_SMALL))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert bad not in plan, (name, bad)
        # column pruning: no scan reads a column that no query uses
        for unused in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "p_brand", "p_retailprice",
                       "o_totalprice", "c_acctbal"):
            assert unused not in plan, (name, unused)


def test_dedup_never_shuffles_matched_pairs(spark):
    """Tickets are dealt by id before the broadcast join; the matches of a ticket are then in one place."""
    for name in ("match_distinct_ticket", "match_row_predicate", "distinct_id_ticket_year", "distinct_id_ticket"):
        plan = plan_text(QUERIES[name](spark, SF_SMALL))
        assert "hashpartitioning(ticket_id" in plan, name
        assert not re.search(r"hashpartitioning\(segment_id#\d+L?, ticket_id", plan), name
