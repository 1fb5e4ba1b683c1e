"""Address-to-segment matching: an equi join plus a range residual.

Join keys: borough, street, side (odd numbers on the left, even on the right)
and, when ``bin_width`` is set, level and house-number block. The range test and
the compound-number rule stay as the residual predicate. Everything is
declarative joins, so Catalyst plans them as hash joins (never a nested loop).

* A side sits at the level of its length (``segments.with_levels``), in one or
  two blocks. A probe first meets the level map (borough, street -> levels that
  the street has sides at; a street without sides ends the probe here) and then
  looks up its own block once at each of those levels. One wide side so costs
  the probes of its own street one more lookup, and no others.
* The segment-side table (bounded by the number of street segments, not by the
  number of tickets) is measured with one aggregate. Under
  ``policy.broadcast_max_bytes`` it is broadcast with its level map; tickets then
  stream through the hash joins without any shuffle of raw tickets. (An input
  with fewer partitions than cores is rebalanced at its source, right after the
  scan.)
* Over the bound, tickets are first pre-aggregated to distinct
  (address, year) probes with a count (map-side combine, so hot addresses
  collapse before the shuffle), and joined with a sort-merge join. House-number
  blocks keep every join key small even for a very long street. Where the
  probes must stay raw (dedup by ticket), the streets that hold more than one in
  ``hot_keys`` of the tickets are found by one bounded counting pass; only their
  probes get a salt derived from the ticket id, and only their sides are
  replicated per salt value. AQE's skew join splits what is left.

Numbers of more than 18 digits are all ``LONG_NUMBER`` as BIGINTs, larger than
every other number: where ticket or side has none of them BIGINTs tell
everything, and only where both have, their ``long`` keys decide.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.parsing import parity_is_odd
from curbline.operators.segments import (
    SIDE_COLUMNS,
    block_at,
    explode_blocks,
    level_map,
    level_widths,
    with_levels,
)
from curbline.policy import MatchPolicy

# Bytes per broadcast row besides its strings: UnsafeRow header + 8 bytes per
# field, plus hash-relation overhead.
_ROW_OVERHEAD = 16
_FIELD_BYTES = 8
_HASH_FACTOR = 2


def _rule(policy: MatchPolicy, number: Callable[[str], Column], end: Callable[[str], Column],
          no_suffix: Column, branch: Column) -> Column:
    """The policy's rule over a ticket's ``number`` (hn, suffix) and a side's ``end`` (lo, ..., o_hi_c)."""
    a, b = number("hn"), number("suffix")
    in_base = (end("lo") <= a) & (a <= end("hi"))
    in_suffix = (end("lo_c") <= b) & (b <= end("hi_c"))
    rule = policy.compound
    if rule == "four_branch":
        # kind 0: base branch (number alone in range, side by parity of hn)
        # kind 1: compound branch (both parts in range, side by parity of suffix)
        return in_base & (branch | in_suffix)
    if rule == "same_side":
        return in_base & (no_suffix | in_suffix)
    if rule == "either_side":
        return in_base & (no_suffix | in_suffix | ((end("o_lo_c") <= b) & (b <= end("o_hi_c"))))
    if rule == "wrong_high":
        # suffix >= low suffix, but the BASE number compared with the high suffix
        known = end("lo_c").isNotNull() & end("hi_c").isNotNull()
        return in_base & (no_suffix | (known & (end("lo_c") <= b) & (a <= end("hi_c"))))
    if rule == "zero_default":
        return in_base & in_suffix
    raise ValueError(f"unknown compound rule {rule!r}")


def _condition(policy: MatchPolicy, p: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
    no_suffix, branch = p("hn_suffix").isNull(), p("kind") == 0
    plain = _rule(policy, lambda n: p("hn" if n == "hn" else "hn_suffix"), s, no_suffix, branch)
    exact = _rule(policy, lambda n: p("long")[n], lambda e: s("long")[e], no_suffix, branch)
    # long numbers are equal as BIGINTs, so the plain rule holds wherever the exact one does
    return plain & (p("long").isNull() | s("long").isNull() | exact)


def match_condition(policy: MatchPolicy, p: str = "p", s: str = "s") -> Column:
    """Residual predicate of one (probe, segment side) pair.

    ``hn``/``hn_suffix`` belong to the ticket, ``lo``..``o_hi_c`` to the side.
    """
    return _condition(policy, lambda c: F.col(f"{p}.{c}"), lambda c: F.col(f"{s}.{c}"))


def pair_matches(policy: MatchPolicy, probe: Column, side: Column) -> Column:
    """The same of a probe and a side that are structs."""
    return _condition(policy, lambda c: probe[c], lambda c: side[c])


def _is_odd(number: str, key: str) -> Column:
    """Parity of a number of any length; that of a long one is its last digit's."""
    long = F.col(f"long.{key}")
    return F.when(long.isNotNull(), F.substring(long, -1, 1).isin(*"13579")).otherwise(parity_is_odd(F.col(number)))


def ticket_probes(tickets: DataFrame, policy: MatchPolicy) -> DataFrame:
    """Normalised tickets -> probes with the side they look up.

    Under ``four_branch`` a compound ticket produces two probes, one per
    branch, so that both branches are counted (a sum, not an OR).
    """
    suffix = F.col("hn_suffix")
    if policy.compound == "four_branch":
        kinds = F.when(suffix.isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        probes = tickets.select("*", F.explode(kinds).alias("kind"))
        is_left = F.when(F.col("kind") == 0, _is_odd("hn", "hn")).otherwise(_is_odd("hn_suffix", "suffix"))
    else:
        probes = tickets.select("*", F.lit(0).alias("kind"))
        is_left = _is_odd("hn", "hn")  # odd numbers are on the left side
    # hn is never NULL here (normalize_tickets drops those rows). The coalesce
    # only tells Catalyst that the join keys are not nullable, so it does not
    # infer extra IS NOT NULL filters that re-evaluate the house-number parse.
    return probes.withColumn("is_left", F.coalesce(is_left, F.lit(False)))


@dataclass(frozen=True)
class SideStats:
    """Rows and estimated bytes of the side table, and those of its level map."""

    rows: int
    bytes: int
    map_bytes: int


def measure_sides(sides: DataFrame, policy: MatchPolicy) -> SideStats:
    """One aggregate over the segment sides; a blocked side counts two rows."""
    fixed = _ROW_OVERHEAD + _FIELD_BYTES * (len(SIDE_COLUMNS) + 2)
    entries = 2 if policy.bin_width else 1
    row_bytes = (F.lit(fixed) + F.octet_length("segment_id") + F.octet_length("street")) * F.lit(_HASH_FACTOR * entries)
    r = sides.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b"),
        # the sketch may be off by a few hundredths: count a tenth more
        (F.approx_count_distinct(F.struct("boro", "street")) * F.lit(1.1)
         * (F.coalesce(F.max(F.octet_length("street")), F.lit(0)) + F.lit(fixed)) * F.lit(_HASH_FACTOR)).alias("m"),
    ).first()
    return SideStats(int(r["n"]) * entries, int(r["b"]), int(r["m"]))


_BETWEEN = "|"  # the borough, a number, is what follows the last one


def _street_name() -> Column:
    return F.concat(F.col("street"), F.lit(_BETWEEN), F.col("boro").cast("string"))


def hot_streets(probes: DataFrame, policy: MatchPolicy) -> list[tuple[int, str]]:
    """(boro, street) of the streets with more than one in ``hot_keys`` of the probes; so never more than that many.

    One pass over the two columns, counted in a sketch of bounded size, which
    holds every item that frequent: no key is shuffled.
    """
    r = probes.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", _street_name(), F.lit(policy.hot_keys), F.lit(16 * policy.hot_keys)).alias("top"),
    ).first()
    hot = [x["item"].rsplit(_BETWEEN, 1) for x in r["top"] or [] if x["item"] and x["count"] * policy.hot_keys > r["n"]]
    return [(int(boro), street) for street, boro in hot]


def _is_hot(hot: list[tuple[int, str]]) -> Column:
    if not hot:
        return F.lit(False)
    return F.coalesce(_street_name().isin(*[f"{street}{_BETWEEN}{boro}" for boro, street in hot]), F.lit(False))


def salted_probes(probes: DataFrame, is_hot: Column, salts: int) -> DataFrame:
    """Probes of hot keys get a salt from their ticket (from the house number where the ticket has no id)."""
    spread = F.hash(F.coalesce(F.nullif(F.col("ticket_id"), F.lit("")), F.col("hn").cast("string")), "year")
    return probes.withColumn("salt", F.when(is_hot, F.pmod(spread, F.lit(salts))).otherwise(F.lit(0)))


def salted_sides(sides: DataFrame, is_hot: Column, salts: int) -> DataFrame:
    """Hot keys' rows once for each salt, all others once."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return sides.select("*", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))).alias("salt"))


def _meet(probes: DataFrame, sides: DataFrame, keys: list[str], broadcast: bool, condition: Column | None = None) -> DataFrame:
    # Over the measured bound the join is pinned to sort-merge (which can spill),
    # so that an optimistic size estimate cannot turn it into a broadcast.
    p, s = probes.alias("p"), (F.broadcast(sides) if broadcast else sides.hint("merge")).alias("s")
    cond = [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys]
    return p.join(s, cond if condition is None else [*cond, condition], "inner")


def match_pairs(tickets: DataFrame, segment_sides: DataFrame, policy: MatchPolicy, more: Sequence[str] = ()) -> DataFrame:
    """All (segment, ticket) matches; ``more``: columns of the tickets to keep, matches are counted apart by them.

    Returns ``(segment_id, year, n)`` where ``n`` is a multiplicity to sum,
    or, when the policy deduplicates by ticket, ``(segment_id, ticket_id, year,
    is_left, spread)`` with one row per match.
    """
    by_ticket = policy.dedup != "none"
    stats = measure_sides(segment_sides, policy)
    broadcast = stats.bytes <= policy.broadcast_max_bytes

    probes = ticket_probes(tickets, policy)
    columns = ["boro", "street", "is_left", "hn", "hn_suffix", "long", "kind", "year", *more]
    # raw probes (one row per ticket): needed to deduplicate by ticket; chosen
    # for a broadcast join (no shuffle); otherwise probes are pre-aggregated
    raw = by_ticket or (broadcast if policy.preaggregate == "auto" else policy.preaggregate == "never")
    if by_ticket:
        payload = ["ticket_id", *more, "year", "is_left", "spread"]
        # matches of a ticket are deduplicated; those without an id would all be dealt to one task, so they are also
        # dealt by address, which their deduplication takes into account
        nameless = F.coalesce(F.col("ticket_id"), F.lit("")) == ""
        columns = [*columns, "ticket_id", "spread"]
        probes = probes.withColumn("spread", F.when(nameless, F.hash("boro", "street", "hn", "hn_suffix")).otherwise(F.lit(0)))
    else:
        payload = [*more, "year", "n"]
        columns = [*columns, "n"]
        if raw:  # the counts are combined map-side after the join
            probes = probes.withColumn("n", F.lit(1).cast("bigint"))

    salt: list[str] = []
    sides = segment_sides
    if raw and not broadcast and policy.skew_salt > 1:
        # a stream can't be counted beforehand: all its streets count as hot
        is_hot = F.lit(True) if tickets.isStreaming else _is_hot(hot_streets(probes.select("boro", "street"), policy))
        probes, sides = salted_probes(probes, is_hot, policy.skew_salt), salted_sides(sides, is_hot, policy.skew_salt)
        salt = ["salt"]
    probes = probes.select(*columns, *salt) if raw else (
        # combine duplicate addresses (map-side first) before the shuffle
        probes.groupBy(*[c for c in columns if c != "n"]).agg(F.count(F.lit(1)).alias("n")))
    if by_ticket and broadcast:
        # the deduplication groups by segment and ticket: rows dealt by ticket before the join are in place for
        # it, and the join's fan-out is never shuffled
        probes = probes.repartition("ticket_id", "spread")
    return meet_by_block(probes, sides, [], stats, policy, salt=salt).select(
        F.col("s.segment_id").alias("segment_id"), *[F.col(f"p.{c}").alias(c) for c in payload])


def meet_by_block(probes: DataFrame, sides: DataFrame, more: list[str], stats: SideStats, policy: MatchPolicy,
                  where: Column | None = None, salt: Sequence[str] = ()) -> DataFrame:
    """All matches of probes ``p`` and sides ``s`` (that ``where`` holds for). ``more``: the sides' columns besides
    ``SIDE_COLUMNS``; ``salt``: a key besides the street."""
    keys, broadcast = ["boro", "street", "is_left"], stats.bytes <= policy.broadcast_max_bytes
    if policy.bin_width:
        widths = level_widths(policy.bin_width, policy.level_step)
        placed = with_levels(sides, widths)
        small = broadcast or stats.map_bytes * (policy.skew_salt if salt else 1) <= policy.broadcast_max_bytes
        met = _meet(probes, level_map(placed, salt), ["boro", "street", *salt], small).select("p.*", F.explode("s.levels").alias("level"))
        # hn is never NULL; the coalesce only says so, as above
        probes = met.withColumn("bin", F.coalesce(block_at(F.col("hn"), F.col("level"), widths), F.lit(-1).cast("bigint")))
        sides = explode_blocks(placed, [*salt, *more])
        keys = [*keys, "level", "bin"]
    condition = match_condition(policy) if where is None else match_condition(policy) & where
    return _meet(probes, sides, [*keys, *salt], broadcast, condition)
