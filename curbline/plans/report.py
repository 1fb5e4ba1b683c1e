"""The segment report: per street segment, yearly event counts and their trend.

    tickets --normalize--> probes --+
                                    |-- join (boro, street, side[, block]) + range residual
    segments --sides/keys/blocks----+
        --> (segment, year, n), each ticket once where the policy says so --> U spine zeros
        --> one aggregation per segment --> count_<year> x N, slope

The plan is built lazily and runs as one job at the sink (plus one small
aggregate over the segment sides that sizes the join strategy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from curbline.functions.trend import apply_rounding, slope_expr
from curbline.operators.counting import explode_per_year, yearly_vector
from curbline.operators.matching import match_pairs
from curbline.operators.once import counted_once
from curbline.operators.segments import segment_sides, segment_spine
from curbline.operators.sweep import sweep_counts
from curbline.operators.tickets import normalize_tickets
from curbline.policy import MatchPolicy, preset


def segment_counts(tickets: DataFrame, segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """(segment_id, year, n): matches per segment and year, before the spine."""
    return side_counts(tickets, segment_sides(segments, policy), policy)


def side_counts(tickets: DataFrame, sides: DataFrame, policy: MatchPolicy) -> DataFrame:
    """The same of segment sides that are at hand."""
    norm = normalize_tickets(tickets, policy)
    if policy.range_join == "sweep":
        return sweep_counts(norm, sides, policy)
    if policy.dedup != "none":
        return counted_once(norm, sides, policy)
    return match_pairs(norm, sides, policy).select("segment_id", "year", "n")


def with_slope(wide: DataFrame, policy: MatchPolicy) -> DataFrame:
    slope = apply_rounding(slope_expr(policy.count_columns, policy.years), policy.rounding)
    return wide.select("segment_id", *policy.count_columns, slope.alias("slope"))


def segment_report(tickets: DataFrame, segments: DataFrame, policy: MatchPolicy | str = "canonical") -> DataFrame:
    """Report rows ``(segment_id, count_<y1>, ..., count_<yN>, slope)``.

    ``tickets`` needs text columns ticket_id, issue_date, county, house_number,
    street_name; ``segments`` needs segment_id, l_low, l_high, r_low, r_high,
    street_label, alt_label (only if the policy uses it), boro_code,
    full_street.
    """
    if isinstance(policy, str):
        policy = preset(policy)
    counts = segment_counts(tickets, segments, policy)
    wide = yearly_vector(counts, segment_spine(segments, policy), policy.years)
    if policy.group == "per_id_year":
        wide = explode_per_year(wide, policy.years)
    report = with_slope(wide, policy)
    if policy.order_by_id:
        report = report.orderBy("segment_id")
    return report
