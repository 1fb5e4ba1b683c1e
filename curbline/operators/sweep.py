"""Range counts by a sorted sweep, for tickets and segments that are both large.

How many tickets lie in ``[lo, hi]`` is the number at or below ``hi`` less the number below ``lo``. So no pair is ever
made: tickets, summed per address and year, and the two ends of every side are united, sorted by house number within
(borough, street, side, number range), and a running sum of the tickets is read off at the ends. A street's numbers are
cut into ranges, so that a long street is many sorted runs; what the ranges before a run add up to is carried into it
from the ranges' totals (one small row per street and range). All steps are sorts, windows and aggregations that Spark
spills; none depends on how many tickets a side matches.

That counts tickets whose rule needs the base number only. Tickets with a suffix under a rule that tests it keep the
equi join of ``operators.matching``; ``sweep_counts`` unites both, from one sum of the tickets per address. Numbers of any
length are ordered by their BIGINT, then by their key. Dedup by ticket needs the pairs and is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions.parsing import LONG_NUMBER
from curbline.operators.matching import measure_sides, meet_by_block, ticket_probes
from curbline.policy import MatchPolicy

#: House numbers per sorted run of a street's side.
RANGE_WIDTH = 10_000

STREET = ("boro", "street", "is_left")
#: Order of rows at one number: a side's low end before the tickets, its high end after them.
LOW, TICKET, HIGH = 0, 1, 2


def swept(tickets: DataFrame, sides: DataFrame, years: Sequence[int], range_width: int = RANGE_WIDTH) -> DataFrame:
    """(segment_id, count_<year>...): tickets (``boro, street, is_left, hn, long, year``, and ``n`` where a row stands for
    several) within each side's base range."""
    columns = [f"count_{y}" for y in years]
    zero = F.lit(0).cast("bigint")
    n = F.col("n") if "n" in tickets.columns else F.lit(1).cast("bigint")
    # a hot address is one row from here on
    summed = tickets.groupBy(*STREET, "hn", F.col("long.hn").alias("key")).agg(
        *[F.sum(F.when(F.col("year") == y, n).otherwise(zero)).alias(c) for y, c in zip(years, columns)])

    def ends(kind: int, end: str) -> DataFrame:
        return sides.where(not_empty).select(*STREET, F.col(end).alias("number"), F.col(f"long.{end}").alias("key"),
                                             F.lit(kind).alias("kind"), "segment_id", *[zero.alias(c) for c in columns])

    not_empty = (F.col("lo") < LONG_NUMBER) | (F.col("long.lo") <= F.col("long.hi"))
    points = (
        summed.select(*STREET, F.col("hn").alias("number"), "key", F.lit(TICKET).alias("kind"),
                      F.lit(None).cast("string").alias("segment_id"), *columns)
        .unionByName(ends(LOW, "lo")).unionByName(ends(HIGH, "hi"))
        # numbers that a BIGINT tells apart need no key; long ones are ordered by it
        .withColumn("key", F.when(F.col("number") >= LONG_NUMBER, F.col("key")))
        # never NULL; the coalesce says so, and Catalyst infers no filters for the join that keep the two uses of the
        # points from sharing what they shuffle
        .withColumn("run", F.coalesce(F.call_function("div", F.col("number"), F.lit(range_width).cast("bigint")), F.lit(-1)))
        .withColumns(_never_null("boro", "street"))
    )
    so_far = (Window.partitionBy(*STREET, "run").orderBy("number", "key", "kind")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = points.select(*STREET, "run", "kind", "segment_id", *[F.sum(c).over(so_far).alias(c) for c in columns])
    before = Window.partitionBy(*STREET).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = (points.groupBy(*STREET, "run").agg(*[F.sum(c).alias(c) for c in columns])
               .select(*STREET, "run", *[F.coalesce(F.sum(c).over(before), zero).alias(f"carried_{c}") for c in columns]))
    sign = F.when(F.col("kind") == HIGH, 1).otherwise(-1)
    return (local.where(F.col("kind") != TICKET).join(carried, [*STREET, "run"]).groupBy("segment_id")
            .agg(*[F.sum(sign * (F.col(c) + F.col(f"carried_{c}"))).cast("bigint").alias(c) for c in columns]))


def _never_null(*columns: str) -> dict[str, Column]:
    """Keys that are never NULL here (normalize_tickets, segment_sides), said so."""
    none = {"boro": F.lit(-1), "street": F.lit("")}
    return {c: F.coalesce(F.col(c), none[c]) for c in columns}


def by_base_number_alone(policy: MatchPolicy) -> Column:
    """Probes for which the policy's rule tests nothing but the base number."""
    if policy.compound == "zero_default":
        return F.lit(False)
    if policy.compound == "four_branch":
        return F.col("kind") == 0
    return F.col("hn_suffix").isNull()


def sweep_counts(tickets: DataFrame, sides: DataFrame, policy: MatchPolicy, range_width: int = RANGE_WIDTH) -> DataFrame:
    """``(segment_id, year, n)`` of normalised tickets and segment sides, like ``match_pairs``: the sweep for tickets
    that the base number decides, the join for the others."""
    if policy.dedup != "none":
        raise ValueError("a sweep counts tickets without pairs: it can't deduplicate them per segment")
    alone = by_base_number_alone(policy)
    # the tickets are read once: both parts are taken from their sums per address. ``alone`` belongs to the address; as
    # an aggregate it is tested above the shuffle, so that both share it
    addresses = (ticket_probes(tickets, policy).withColumns(_never_null("boro", "street"))
                 .groupBy(*STREET, "hn", "hn_suffix", "long", "kind", "year")
                 .agg(F.count(F.lit(1)).alias("n"), F.bool_or(alone).alias("alone")))
    wide = swept(addresses.where("alone"), sides, policy.years, range_width)
    long = wide.select("segment_id", F.inline(F.array(*[
        F.struct(F.lit(y).alias("year"), F.col(f"count_{y}").alias("n")) for y in policy.years])))
    # handed on by a generator: what Catalyst infers from the join stays above it, and the shuffle below is the same
    others = addresses.where("not alone").select(F.inline(F.array(F.struct(*[
        F.col(c) for c in (*STREET, "hn", "hn_suffix", "long", "kind", "year", "n")]))))
    pairs = meet_by_block(others, sides, [], measure_sides(sides, policy), policy)
    return long.where("n > 0").unionByName(pairs.select("s.segment_id", "p.year", "p.n"))
