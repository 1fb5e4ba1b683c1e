"""Counting, deduplication, yearly vectors and the zero-filled spine.

All aggregations are declarative ``groupBy``s, so Spark combines partial
counts map-side before every shuffle: a segment (or id) holding a third of
all rows still sends only one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.policy import MatchPolicy


def dedup_matches(matched: DataFrame, policy: MatchPolicy) -> DataFrame:
    """Matches -> (segment_id, year, n) under the policy's dedup mode.

    ``none``            every match counts (``n`` already carries multiplicity).
    ``id_ticket_year``  a ticket counts once per (segment, year).
    ``id_ticket_year_side``
                        a ticket counts once per (segment, year) and side: odd
                        and even matches are deduplicated apart, then united.
    ``id_ticket``       a ticket counts once per segment, in its earliest year
                        (a deterministic choice where a ticket id carries two
                        years).

    Tickets without an id (NULL, or empty: two ids like any other) may be very many and are dealt over the tasks by
    ``spread``: each task deduplicates its own, and the segment's aggregate, which has few rows by then, the rest.
    """
    if policy.dedup == "none":
        return matched.select("segment_id", "year", "n")
    if policy.dedup not in ("id_ticket", "id_ticket_year", "id_ticket_year_side"):
        raise ValueError(f"unknown dedup mode {policy.dedup!r}")
    if policy.dedup == "id_ticket":
        once = matched.groupBy("segment_id", "ticket_id", "spread").agg(F.min("year").alias("year"))
    else:
        side = ["is_left"] if policy.dedup == "id_ticket_year_side" else []
        once = matched.select("segment_id", "ticket_id", "spread", "year", *side).distinct()
    if policy.dedup != "id_ticket_year_side":
        once = once.withColumn("is_left", F.lit(True))
    named = F.coalesce(F.col("ticket_id"), F.lit("")) != ""
    # one bit for each nameless id (NULL, '') and side that has matched
    seen = F.when(~named, F.when(F.col("ticket_id").isNull(), 1).otherwise(2) * F.when(F.col("is_left"), 1).otherwise(4))
    per_year = once.groupBy("segment_id", "year").agg(
        F.count_if(named).alias("named"), F.coalesce(F.bit_or(seen), F.lit(0)).alias("seen"))
    return count_named_and_nameless(per_year, policy)


def count_named_and_nameless(per_year: DataFrame, policy: MatchPolicy) -> DataFrame:
    """(segment_id, year, named, seen) -> (segment_id, year, n): tickets with ids, and the bits of those without."""
    if policy.dedup == "id_ticket":
        # a nameless id counts in the first of the segment's years that has it
        before = Window.partitionBy("segment_id").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.bit_or("seen").over(before), F.lit(0))
        per_year = per_year.withColumn("seen", F.col("seen").bitwiseAND(F.bitwise_not(earlier)))
    return per_year.select("segment_id", "year", (F.col("named") + F.bit_count("seen")).cast("bigint").alias("n"))


def yearly_vector(counts: DataFrame, spine: DataFrame, years: Sequence[int],
                  id_col: str = "segment_id") -> DataFrame:
    """(id, year, n) plus a spine of ids -> one row per id with ``count_<year>``.

    The spine is united as zero rows and summed together with the counts (one
    aggregation, one shuffle), instead of a second join.
    """
    zeros = spine.select(id_col, F.lit(None).cast("int").alias("year"), F.lit(0).cast("bigint").alias("n"))
    rows = counts.select(id_col, "year", F.col("n").cast("bigint").alias("n")).unionByName(zeros)
    return rows.groupBy(id_col).agg(
        *[F.sum(F.when(F.col("year") == y, F.col("n")).otherwise(F.lit(0).cast("bigint"))).alias(f"count_{y}")
          for y in years]
    )


def explode_per_year(wide: DataFrame, years: Sequence[int], id_col: str = "segment_id") -> DataFrame:
    """The pivot-by-(id, year) shape: one row per (id, year with a count),
    holding only that year's count; ids without counts keep one zero row.

    Built with a generator over the per-id row, so it needs no extra shuffle.
    """
    cols = [f"count_{y}" for y in years]
    zero = F.lit(0).cast("bigint")

    def only(i: int):
        return F.struct(*[(F.col(c) if j == i else zero).alias(c) for j, c in enumerate(cols)])

    singles = F.filter(
        F.array(*[F.when(F.col(c) > 0, only(i)) for i, c in enumerate(cols)]),
        lambda x: x.isNotNull(),
    )
    all_zero = F.array(F.struct(*[zero.alias(c) for c in cols]))
    rows = F.when(F.size(singles) > 0, singles).otherwise(all_zero)
    return wide.select(id_col, F.inline(rows))


# ------------------------------------------------- generic (id, year) events


def count_per_id_year(events: DataFrame, id_col: str = "id", year_col: str = "year") -> DataFrame:
    return events.groupBy(id_col, year_col).agg(F.count(F.lit(1)).alias("n"))


def yearly_pivot(events: DataFrame, years: Sequence[int], id_col: str = "id",
                 year_col: str = "year") -> DataFrame:
    """One row per id with events; always pass the value list so that a year
    absent from the data still yields its column."""
    piv = events.groupBy(id_col).pivot(year_col, list(years)).count()
    renamed = [F.coalesce(F.col(str(y)), F.lit(0).cast("bigint")).alias(f"count_{y}") for y in years]
    return piv.select(id_col, *renamed)


def yearly_pivot_per_id_year(events: DataFrame, years: Sequence[int], id_col: str = "id",
                             year_col: str = "year") -> DataFrame:
    """The pivot keyed by (id, year): each row holds one non-zero column."""
    piv = events.groupBy(id_col, year_col).pivot(year_col, list(years)).count().drop(year_col)
    return piv.select(id_col, *[F.coalesce(F.col(str(y)), F.lit(0).cast("bigint")).alias(f"count_{y}")
                                for y in years])


def one_hot_vector_sum(events: DataFrame, years: Sequence[int], id_col: str = "id",
                       year_col: str = "year") -> DataFrame:
    """Each event as a unit vector over the years, summed per id."""
    return events.groupBy(id_col).agg(
        *[F.count_if(F.col(year_col) == y).cast("bigint").alias(f"count_{y}") for y in years]
    )


def spine_zero_fill(spine: DataFrame, wide: DataFrame, id_col: str = "id") -> DataFrame:
    """Spine LEFT JOIN counts, NULL counts filled with 0."""
    ids = spine.select(id_col).distinct()
    cols = [c for c in wide.columns if c != id_col]
    return ids.join(wide, id_col, "left").na.fill(0, subset=cols)


def spine_union_zero(spine: DataFrame, events: DataFrame, years: Sequence[int], id_col: str = "id",
                     year_col: str = "year") -> DataFrame:
    """Zero rows for every spine id united with the events' counts, then summed."""
    counts = events.select(F.col(id_col), F.col(year_col).alias("year"),
                           F.lit(1).cast("bigint").alias("n"))
    return yearly_vector(counts, spine.select(id_col), years, id_col=id_col)
