"""Ticket normalisation: validity filters, year, borough code, house number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from curbline.functions.parsing import (
    aliases_for,
    borough_code,
    fold,
    house_first_two,
    house_number_parses,
    is_long,
    long_key,
    split_first_two,
    strict_int,
    strict_tuple,
    tuple_texts,
    year_suffix,
)
from curbline.policy import MatchPolicy


def house_number_parts(house, ticket_split: str):
    """(hn, hn_suffix) as BIGINT under a ticket split mode."""
    if ticket_split == "first_two":
        return house_first_two(house)
    if ticket_split == "strict_tuple":
        return strict_tuple(house)
    raise ValueError(f"unknown ticket split {ticket_split!r}")


def house_number_texts(house, ticket_split: str):
    """The texts of (hn, hn_suffix) under a ticket split mode."""
    return split_first_two(house) if ticket_split == "first_two" else tuple_texts(house)


def valid_ticket_condition(policy: MatchPolicy, has_year_column: bool = False):
    """Rows every variant keeps: year in the window, known borough alias,
    non-empty street and house number.

    Curated tickets carry an integer ``year`` partition column (equal to the
    issue-date suffix); testing it as well lets the scan skip whole year
    partitions.
    """
    years = [str(y) for y in policy.years]
    known = [a for names in aliases_for(policy.aliases).values() for a in names]
    cond = (
        year_suffix(F.col("issue_date")).isin(years)
        # same rows as "borough_code(county) IS NOT NULL", but a plain IN list
        # that Parquet/CSV scans accept as a pushed filter
        & F.col("county").isin(*known)
        & (F.col("street_name") != "")
        & (F.col("house_number") != "")
    )
    if has_year_column:
        cond = F.col("year").isin(list(policy.years)) & cond
    return cond


REASONS = ("out_of_window", "unknown_county", "empty_street", "empty_house", "alpha_house", "unparsed_house", "ok")


def reject_reason(policy: MatchPolicy):
    """Why a raw ticket is not matched, the first reason that holds; ``ok`` for those that are."""
    in_window = F.coalesce(year_suffix(F.col("issue_date")).isin([str(y) for y in policy.years]), F.lit(False))
    house = F.coalesce(F.col("house_number"), F.lit(""))
    return (F.when(~in_window, "out_of_window")
            .when(borough_code(F.col("county"), policy.aliases).isNull(), "unknown_county")
            .when(F.coalesce(F.col("street_name"), F.lit("")) == "", "empty_street")
            .when(house == "", "empty_house")
            .when(house.rlike(r"^\p{L}+\z"), "alpha_house")
            .when(~house_number_parses(house, policy.ticket_split), "unparsed_house")
            .otherwise("ok"))


def observed_rejects(tickets: DataFrame, policy: MatchPolicy) -> tuple[DataFrame, Observation]:
    """The same tickets, and an observation that holds, once a job has read them, the number of tickets per reason: the
    report's own pass counts its rejects, none is read twice."""
    seen = Observation()
    reason = F.inline(F.array(F.struct(reject_reason(policy).alias("_reason"))))
    counted = tickets.select("*", reason).observe(seen, *[F.count_if(F.col("_reason") == r).alias(r) for r in REASONS])
    return counted.drop("_reason"), seen


def normalize_tickets(tickets: DataFrame, policy: MatchPolicy, drop_unparsed: bool = True,
                      more: Sequence[str] = ()) -> DataFrame:
    """Raw ticket text -> (ticket_id, year, boro, street, hn, hn_suffix, long), and the columns ``more`` as they are.

    ``long`` holds keys that order numbers of any length; it is NULL for house numbers of
    at most 18 characters, nearly all, whose BIGINTs tell everything.

    ``hn`` is NULL when the base number is not a plain integer; such a ticket
    can never fall inside a range, so it is dropped here (before any shuffle)
    unless ``drop_unparsed`` is False.
    """
    keep = valid_ticket_condition(policy, "year" in tickets.columns)
    if drop_unparsed:
        # the same rows as "hn IS NOT NULL", tested on the raw text
        keep = keep & house_number_parses(F.col("house_number"), policy.ticket_split)
    base, suffix = house_number_texts(F.col("house_number"), policy.ticket_split)
    # a step of its own: each part is split off once and then read several times
    texts = tickets.where(keep).select(
        "ticket_id", *more,
        year_suffix(F.col("issue_date")).try_cast("int").alias("year"),
        borough_code(F.col("county"), policy.aliases).alias("boro"),
        fold(F.col("street_name"), policy.fold_case).alias("street"),
        base.alias("base"), suffix.alias("suffix"), is_long(F.col("house_number")).alias("is_long"))
    keys = F.struct(long_key(F.col("base")).alias("hn"), long_key(F.col("suffix")).alias("suffix"))
    numbers = F.struct(
        # Rows are restricted to parseable numbers unless drop_unparsed is off; the coalesce declares hn as never NULL
        # then. (-1 would match no range.)
        (F.coalesce(strict_int(F.col("base")), F.lit(-1).cast("bigint")) if drop_unparsed else strict_int(F.col("base"))).alias("hn"),
        strict_int(F.col("suffix")).alias("hn_suffix"),
        F.when(F.col("is_long"), keys).alias("long"))
    # handed on by a generator as plain columns: tests of the numbers that Catalyst infers from the join stay above it
    # and don't parse the text once more each
    return texts.select("ticket_id", *more, "year", "boro", "street", F.inline(F.array(numbers)))
