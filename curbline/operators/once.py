"""Tickets counted once per segment, without a row for each (segment, ticket) match.

A ticket id may stand in several rows, and a segment id in several sides. Both are put in an order, and a match counts
only if no match of the same ticket and segment comes before it. That can be told from the matching rows themselves:

* ``earlier``: the addresses of the rows of the same ticket that come before a row, of the earliest years first.
* ``around``: all sides of the segment, of which the first ``place`` - 1 come before a side.

So nothing is shuffled by (segment, ticket). Rows whose ticket has no other row on their street are nearly all: they are
summed per address before the join, like those of a report without deduplication. The others keep their ``earlier``.
Sides on streets without tickets go first; a segment is ``plain`` if its sides left are at most one left and one right
of a single street: its matches of a row concern rows on that street alone. All other segments are met by the rows with
the whole of their ``earlier``.

Tickets without an id (NULL, or empty: two ids like any other) may be very many; they are summed per address and leave
one bit for each segment and year. Ids with more than ``MOST`` other rows, and segments with more than ``MOST`` other
sides, keep the plain way: one row per match, made distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.operators.counting import count_named_and_nameless
from curbline.operators.matching import SideStats, measure_sides, meet_by_block, pair_matches, ticket_probes
from curbline.operators.segments import SIDE_COLUMNS
from curbline.policy import MatchPolicy
from curbline.session import ensure_checkpoint_dir

#: A ticket's rows, or a segment's sides, that one of them keeps beside it at most.
MOST = 16

STREET = ("boro", "street")
ADDRESS = (*STREET, "is_left", "hn", "hn_suffix", "long", "kind")
SIDE = tuple(c for c in SIDE_COLUMNS if c != "segment_id")
PLAIN, LINKED, CROWDED = 0, 1, 2


def sides_by_shape(sides: DataFrame, probes: DataFrame) -> DataFrame:
    """Each different side on a street with tickets once, with ``shape``, ``place`` and ``around``."""
    streets = probes.select(*STREET).distinct()
    own = Window.partitionBy("segment_id")
    ordered = own.orderBy(*[F.col(c) for c in SIDE])
    street, at = F.struct(*STREET), F.struct(*STREET, "is_left")
    known = (
        sides.join(streets, list(STREET), "left_semi").distinct()
        .select(*SIDE_COLUMNS, F.count(F.lit(1)).over(own).alias("sides"),
                (F.min(street).over(own) != F.max(street).over(own)).alias("streets"),
                F.count(F.lit(1)).over(Window.partitionBy("segment_id", *STREET, "is_left")).alias("alike"),
                F.row_number().over(ordered).alias("place"),
                F.collect_list(F.struct(*SIDE)).over(ordered.rowsBetween(-MOST, MOST)).alias("around"))
        .withColumn("alike", F.max("alike").over(own)))
    shape = (F.when(F.col("sides") > MOST + 1, CROWDED).when(F.col("streets") | (F.col("alike") > 1), LINKED).otherwise(PLAIN))
    return known.select(*SIDE_COLUMNS, shape.alias("shape"), "place", "around")


def with_earlier(probes: DataFrame, policy: MatchPolicy) -> DataFrame:
    """Rows with ids, with ``earlier`` and ``many``; those that repeat an earlier address of their ticket are left out."""
    scope = {"id_ticket": [], "id_ticket_year": ["year"], "id_ticket_year_side": ["year", "is_left"]}[policy.dedup]
    own = Window.partitionBy("ticket_id", *scope)
    ordered = own.orderBy("year", *ADDRESS)
    address = F.struct(*ADDRESS)
    rows = probes.repartition("ticket_id").select(
        "ticket_id", "year", *ADDRESS, (F.count(F.lit(1)).over(own) > MOST + 1).alias("many"),
        F.collect_list(address).over(ordered.rowsBetween(-MOST, -1)).alias("earlier"))
    return rows.where((F.size("earlier") == 0) | ~F.array_contains("earlier", address))


def _same_place(e: Column, x: Column) -> Column:
    return (e["boro"] == x["boro"]) & (e["street"] == x["street"]) & (e["is_left"] == x["is_left"])


def _first_of_its_kind(policy: MatchPolicy) -> Column:
    """No other match of the row's ticket and the side's segment comes before this one."""
    def hit(e: Column, x: Column) -> Column:
        return F.coalesce(_same_place(e, x) & pair_matches(policy, e, x), F.lit(False))

    before = F.slice("s.around", F.lit(1), F.col("s.place") - 1)
    own = F.struct(*[F.col(f"p.{c}").alias(c) for c in ADDRESS])
    by_side = (F.col("s.shape") == PLAIN) | ~F.exists(before, lambda x: hit(own, x))
    by_row = ~F.exists("p.earlier", lambda e: F.exists(F.col("s.around"), lambda x: hit(e, x)))
    return by_side & by_row


def counted_once(tickets: DataFrame, segment_sides: DataFrame, policy: MatchPolicy) -> DataFrame:
    """``(segment_id, year, n)`` of normalised tickets and segment sides under the policy's dedup mode: what
    ``dedup_matches(match_pairs(...))`` gives."""
    probes = ticket_probes(tickets, policy)
    # read several times, so kept in the shared folder
    ensure_checkpoint_dir(tickets.sparkSession)
    sides = sides_by_shape(segment_sides, probes).checkpoint()
    shapes = {r["shape"] for r in sides.select("shape").distinct().collect()}
    stats = measure_sides(sides, policy)

    named = F.coalesce(F.col("ticket_id"), F.lit("")) != ""
    rows = with_earlier(probes.where(named), policy)
    few, many = rows.where(~F.col("many")), rows.where("many")
    on_street = F.filter("earlier", lambda e: (e["boro"] == F.col("boro")) & (e["street"] == F.col("street")))
    kept = few.select("year", *ADDRESS, on_street.alias("on_street"), "earlier")

    is_left = F.col("is_left") if policy.dedup == "id_ticket_year_side" else F.lit(True)
    mark = F.when(F.col("ticket_id").isNull(), 1).otherwise(2) * F.when(is_left, 1).otherwise(4)
    summed = [F.count(F.lit(1)).alias("n")]
    alone = kept.where(F.size("on_street") == 0).select("year", *ADDRESS, F.lit(0).alias("mark"))
    nameless = probes.where(~named).select("year", *ADDRESS, mark.alias("mark"))
    found = [_counts(alone.union(nameless).groupBy("year", *ADDRESS, "mark").agg(*summed),
                     sides.select(*SIDE_COLUMNS, "shape"), ["shape"], stats, policy,
                     where=(F.col("p.mark") > 0) | (F.col("s.shape") == PLAIN))]

    with_others = kept.where(F.size("on_street") > 0).select("year", *ADDRESS, F.col("on_street").alias("earlier"))
    for shape, some in ((PLAIN, with_others), (LINKED, kept.drop("on_street"))):
        if shape in shapes:
            found.append(_counts(some.groupBy("year", *ADDRESS, "earlier").agg(F.lit(0).alias("mark"), *summed),
                                 sides.where(F.col("shape") == shape), ["shape", "place", "around"], stats, policy,
                                 then=_first_of_its_kind(policy)))
    rest = [(many, sides)] + ([(few, sides.where(F.col("shape") == CROWDED))] if CROWDED in shapes else [])
    for some, of in rest:
        pairs = meet_by_block(some.select("ticket_id", "year", *ADDRESS), of.select(*SIDE_COLUMNS), [], stats, policy)
        side = ["is_left"] if policy.dedup == "id_ticket_year_side" else []
        once = pairs.select("s.segment_id", "p.ticket_id", "p.year", *[f"p.{c}" for c in side])
        once = (once.groupBy("segment_id", "ticket_id").agg(F.min("year").alias("year")) if policy.dedup == "id_ticket"
                else once.distinct())
        found.append(once.select("segment_id", "year", F.lit(0).alias("mark"), F.lit(1).cast("bigint").alias("n")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    per_year = every.groupBy("segment_id", "year").agg(
        F.coalesce(F.sum(F.when(F.col("mark") == 0, F.col("n"))), F.lit(0)).alias("named"), F.bit_or("mark").alias("seen"))
    return count_named_and_nameless(per_year, policy)


def _counts(probes: DataFrame, sides: DataFrame, more: list[str], stats: SideStats, policy: MatchPolicy,
            where: Column | None = None, then: Column | None = None) -> DataFrame:
    """Matches as ``segment_id``, ``year``, ``mark``, ``n``; ``where`` belongs to the join, ``then`` is tested after it."""
    met = meet_by_block(probes, sides, more, stats, policy, where)
    if then is not None:
        met = met.where(then)
    return met.select("s.segment_id", "p.year", "p.mark", "p.n")
