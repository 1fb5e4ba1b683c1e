"""Segment preparation: side unpivot, street-key explode, house-number blocks.

A segment row carries two house-number ranges (left = odd, right = even). The
matcher needs rows of (segment, side, street key, level, block) so that side,
borough, street, level and block all become hash-join keys and only the range
test remains as a residual predicate.

Levels are block widths: ``width``, 16 times that, and so on. A side is entered
at the first level whose blocks are wider than its range, so it touches one or
two blocks there, however wide it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.parsing import (
    LONG_NUMBER,
    fold,
    is_long,
    is_plain,
    long_key,
    short_int,
    side_texts,
    street_key_coalesce,
    strict_int,
)
from curbline.policy import MatchPolicy

SIDE_COLUMNS = ("segment_id", "boro", "street", "is_left", "lo", "hi", "lo_c", "hi_c", "o_lo_c", "o_hi_c", "long")
#: All that a match asks of a side: sides that agree in it match the same tickets.
RANGE_COLUMNS = SIDE_COLUMNS[1:]


def street_keys(policy: MatchPolicy) -> Column:
    """Array of the street keys a segment answers to under the policy."""
    full = fold(F.col("full_street"), policy.fold_case)
    label = fold(F.col(policy.label_column), policy.fold_case)
    if policy.street_key == "full":
        return F.array(full)
    if policy.street_key == "coalesce":
        return F.array(street_key_coalesce(full, label))
    # OR of two names: each distinct name once, so a pair matches at most once
    return F.array_distinct(F.array(full, label))


def _valid_id(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def borough_number(c: Column) -> Column:
    """A segment's borough code; NULL for anything that is no number an INT can hold."""
    return strict_int(c).try_cast("int")


ENDS = ("l_low", "l_high", "r_low", "r_high")
NUMBERS = ("lo", "hi", "lo_c", "hi_c", "o_lo_c", "o_hi_c")


def parsed_sides(segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """One row per (segment, side) with parsed ranges; no filtering on ranges.

    ``o_lo_c``/``o_hi_c`` carry the opposite side's suffix range, which the
    ``either_side`` compound rule needs (NULL under the others). ``long`` holds
    keys that order numbers of any length, for the segments that have an end of
    more than 18 characters; it is NULL for the others, nearly all. The two kinds
    are parsed apart, so that the common kind's code stays small.
    """
    l_lo, l_hi, l_lo_c, l_hi_c = side_texts(F.col("l_low"), F.col("l_high"), policy.segment_split)
    r_lo, r_hi, r_lo_c, r_hi_c = side_texts(F.col("r_low"), F.col("r_high"), policy.segment_split)
    names = NUMBERS if policy.compound == "either_side" else NUMBERS[:4]

    def side(is_left: bool, *texts) -> Column:
        return F.struct(F.lit(is_left).alias("is_left"), *[t.alias(f"{n}_text") for t, n in zip(texts, names)])

    both = F.array(side(True, l_lo, l_hi, l_lo_c, l_hi_c, r_lo_c, r_hi_c),
                   side(False, r_lo, r_hi, r_lo_c, r_hi_c, l_lo_c, l_hi_c))
    key_type = f"struct<{', '.join(f'{n}: string' for n in NUMBERS)}>"

    def parsed(rows: DataFrame, number, keys: Column) -> DataFrame:
        # the generators hand texts and numbers on as plain columns: each is split once and parsed once, and tests of
        # the numbers are not pushed below the parse (which would write it out once more for each test)
        texts = rows.select("segment_id", borough_number(F.col("boro_code")).alias("boro"),
                            street_keys(policy).alias("streets"), F.inline(both))
        numbers = {n: number(F.col(f"{n}_text")) if n in names else F.lit(None).cast("bigint") for n in NUMBERS}
        return texts.select("segment_id", "boro", "streets", "is_left", F.inline(F.array(F.struct(
            *[c.alias(n) for n, c in numbers.items()], keys.cast(key_type).alias("long")))))

    known = segments.where(_valid_id(F.col("segment_id")))
    far = is_long(*[F.col(c) for c in ENDS])
    # one key after the other over an array: rare rows only, so small code counts for more than speed
    each = F.transform(F.array(*[F.col(f"{n}_text") for n in names]), long_key)
    keys = F.struct(*[(F.get(each, names.index(n)) if n in names else F.lit(None)).alias(n) for n in NUMBERS])
    return parsed(known.where(~far), short_int, F.lit(None)).unionByName(parsed(known.where(far), strict_int, keys))


def segment_sides(segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """Matchable sides: (segment_id, boro, street, is_left, lo, hi, lo_c, hi_c, o_lo_c, o_hi_c, long).

    Sides whose base range does not parse, or is empty (lo > hi), can never
    match any ticket and are dropped here rather than in the join. (Two ends
    of more than 18 digits count as equal here; the join compares them.)
    """
    sides = parsed_sides(segments, policy).where(
        F.col("boro").isNotNull() & F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("lo") <= F.col("hi"))
    )
    return (
        sides.select("*", F.explode("streets").alias("street"))
        .where(F.col("street").isNotNull() & (F.col("street") != ""))
        .select(*SIDE_COLUMNS)
    )


def range_name() -> Column:
    """A side's ``RANGE_COLUMNS`` as one text, different for different ranges. The street comes last: it alone may hold
    the separator."""
    empty = F.lit("")  # a number's text is never empty, so this stands for NULL
    fixed = [F.coalesce(F.col(c).cast("string"), empty) for c in RANGE_COLUMNS if c not in ("street", "long")]
    return F.concat_ws("|", *fixed, F.coalesce(F.to_json("long"), empty), F.col("street"))


def side_ranges(sides: DataFrame) -> DataFrame:
    """The different ranges of segment sides, each once, as sides whose ``segment_id`` is the range's name."""
    return sides.select(*RANGE_COLUMNS).distinct().select(range_name().alias("segment_id"), *RANGE_COLUMNS)


def level_widths(width: int, step: int) -> list[int]:
    """Block widths of all levels; the last one's first block holds every number."""
    widths = [width]
    while widths[-1] <= LONG_NUMBER:
        widths.append(min(widths[-1] * step, 2**62))
    return widths


def block_at(number: Column, level: Column, widths: list[int]) -> Column:
    """The block of a (non-negative) number at a level."""
    width = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in widths]), level + 1)
    return F.call_function("div", number, width)


def with_levels(sides: DataFrame, widths: list[int]) -> DataFrame:
    """Add ``level``, the first whose blocks are wider than the side's range, and its first and last block there."""
    length = F.col("hi") - F.col("lo")
    level = F.lit(0)
    for w in widths[:-1]:
        level = level + F.coalesce(length >= w, F.lit(False)).cast("int")
    placed = sides.select("*", level.alias("level"))
    return placed.select("*", block_at(F.col("lo"), F.col("level"), widths).alias("lo_bin"),
                         block_at(F.col("hi"), F.col("level"), widths).alias("hi_bin"))


def explode_blocks(sides_with_levels: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """One row per block that a side touches at its level: one or two. ``more``: columns to keep besides."""
    touched = F.when(F.col("lo_bin") == F.col("hi_bin"), F.array("lo_bin")).otherwise(F.array("lo_bin", "hi_bin"))
    return sides_with_levels.select(*SIDE_COLUMNS, *more, "level", F.explode(touched).alias("bin"))


def level_map(sides_with_levels: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """``boro``, ``street`` (and ``more`` keys), ``levels``: the levels at which each street has sides."""
    return sides_with_levels.groupBy("boro", "street", *more).agg(F.collect_set("level").alias("levels"))


def segment_spine(segments: DataFrame, policy: MatchPolicy) -> DataFrame:
    """Segment ids that get a report row even without any match.

    ``all_ids``: every non-empty id. ``left_parsed_ids``: only ids whose left
    range parses (the side-unpivot variant builds its spine from that side).
    """
    if policy.spine == "all_ids":
        return segments.where(_valid_id(F.col("segment_id"))).select("segment_id")
    lo, hi, _, _ = side_texts(F.col("l_low"), F.col("l_high"), policy.segment_split)
    return segments.where(_valid_id(F.col("segment_id")) & is_plain(lo) & is_plain(hi)).select("segment_id")
