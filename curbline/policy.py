"""Match policies: one parameter set replaces the six variant scripts.

Every knob names one observable semantic choice (which street column is the
join key, how compound house numbers such as ``70-23`` are compared, whether a
ticket is counted once per segment, ...). Presets reproduce each variant; the
``canonical`` preset is the library default.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

STREET_KEYS = ("full", "coalesce", "either")
LABEL_COLUMNS = ("street_label", "alt_label")
TICKET_SPLITS = ("first_two", "strict_tuple")
SEGMENT_SPLITS = ("each", "pairwise", "strict_zero")
COMPOUND_RULES = ("four_branch", "same_side", "either_side", "wrong_high", "zero_default")
DEDUP_MODES = ("none", "id_ticket", "id_ticket_year", "id_ticket_year_side")
SPINE_MODES = ("all_ids", "left_parsed_ids")
GROUP_MODES = ("per_id", "per_id_year")
ALIAS_SETS = ("full", "short")
RANGE_JOINS = ("pairs", "sweep")
ROUNDING_MODES = ("none", "int_half_even", "2dp")

# Fixed value: the five-year window of the original report (slopes use x = -2..2).
DEFAULT_YEARS = (2015, 2016, 2017, 2018, 2019)


@dataclass(frozen=True)
class MatchPolicy:
    """All semantic and physical choices of one segment report.

    Semantic fields
    ---------------
    street_key      ``full`` full street name only; ``coalesce`` full name, or the
                    label when the full name is empty; ``either`` a ticket street
                    equal to the full name OR the label matches (once per pair).
    label_column    which segment label ``coalesce``/``either`` use.
    fold_case       lower-case street names on both sides before comparing.
    ticket_split    ``first_two``: ``a-b[-...]`` -> (a, b), plain -> (a, NULL);
                    ``strict_tuple``: every part must be an integer, plain -> (a, 0).
    segment_split   ``each``: every range end is split on its own;
                    ``pairwise``: a side's ends are split only if both contain '-';
                    ``strict_zero``: ends parse like ``strict_tuple``; a side whose
                    ends do not both parse is dropped.
    compound        how a compound ticket number is compared (see operators.matching).
    dedup           count a ticket once per (segment) or per (segment, year).
    spine           which segment ids get a row even without matches.
    group           ``per_id`` one row per segment; ``per_id_year`` one row per
                    (segment, year with matches), as the pivot-by-year variant does.
    aliases         borough alias list: all 19 or the 17 without KING/KINGS.
    rounding        slope rounding.
    order_by_id     sort the report by segment id (string order).
    years           the ordered window of years; counts are ``count_<year>``.

    Physical fields
    ---------------
    range_join      ``pairs``: join tickets with sides (operators.matching);
                    ``sweep``: running counts along sorted house numbers, no
                    pairs (operators.sweep), where both sides are large.
    bin_width       house-number block width added to the join key (range join
                    by blocks); ``None`` joins on street keys only. The default
                    100 matches block-wise house numbering (one street block
                    spans about 100 numbers), so a probe meets only the
                    segments of its own block.
    level_step      wider sides are entered at a level of wider blocks, each
                    level's ``level_step`` times as wide as the one before; a
                    probe looks up the levels that its street has.
    broadcast_max_bytes
                    the segment-side table is broadcast only when its measured
                    size is below this bound; otherwise a shuffle join is used.
    skew_salt       on the sort-merge path with raw probes (ticket dedup, where
                    probes keep their ticket id, or ``preaggregate='never'``) the
                    probes of hot streets get ``pmod(hash(ticket_id), skew_salt)``
                    as an extra join key and those streets' sides are replicated
                    that many times, so one hot address is split over
                    ``skew_salt`` tasks; 1 turns it off.
    hot_keys        a street is hot if it has more than one in ``hot_keys`` of the
                    tickets (so there are never more of them).
    preaggregate    ``auto``: stream raw tickets through a broadcast join, but
                    collapse them to distinct probes with a count before a
                    shuffle join; ``always`` / ``never`` force the choice.
    """

    name: str = "canonical"
    street_key: str = "either"
    label_column: str = "street_label"
    fold_case: bool = True
    ticket_split: str = "first_two"
    segment_split: str = "pairwise"
    compound: str = "same_side"
    dedup: str = "none"
    spine: str = "all_ids"
    group: str = "per_id"
    aliases: str = "full"
    rounding: str = "none"
    order_by_id: bool = False
    years: tuple[int, ...] = DEFAULT_YEARS
    range_join: str = "pairs"
    bin_width: int | None = 100
    level_step: int = 16
    broadcast_max_bytes: int = 128 * 1024 * 1024
    preaggregate: str = "auto"
    skew_salt: int = 16
    hot_keys: int = 64

    def __post_init__(self) -> None:
        checks = (
            ("street_key", STREET_KEYS),
            ("label_column", LABEL_COLUMNS),
            ("ticket_split", TICKET_SPLITS),
            ("segment_split", SEGMENT_SPLITS),
            ("compound", COMPOUND_RULES),
            ("dedup", DEDUP_MODES),
            ("spine", SPINE_MODES),
            ("group", GROUP_MODES),
            ("aliases", ALIAS_SETS),
            ("rounding", ROUNDING_MODES),
            ("range_join", RANGE_JOINS),
        )
        for field, allowed in checks:
            value = getattr(self, field)
            if value not in allowed:
                raise ValueError(f"{field}={value!r}; expected one of {allowed}")
        if not self.years or len(set(self.years)) != len(self.years):
            raise ValueError("years must be a non-empty sequence of distinct years")
        if self.range_join == "sweep" and self.dedup != "none":
            raise ValueError("range_join='sweep' makes no pairs, so it can't deduplicate by ticket")
        if self.bin_width is not None and self.bin_width <= 0:
            raise ValueError("bin_width must be positive or None")
        if self.preaggregate not in ("auto", "always", "never"):
            raise ValueError("preaggregate must be auto, always or never")
        if self.skew_salt < 1:
            raise ValueError("skew_salt must be >= 1")
        if self.level_step < 2:
            raise ValueError("level_step must be >= 2")
        if self.hot_keys < 1:
            raise ValueError("hot_keys must be >= 1")

    def with_(self, **changes) -> "MatchPolicy":
        return replace(self, **changes)

    @property
    def count_columns(self) -> list[str]:
        return [f"count_{y}" for y in self.years]


PRESETS: dict[str, MatchPolicy] = {
    # pure-RDD variant: one pipeline per year, four unioned branches
    "four_branch": MatchPolicy(
        name="four_branch", street_key="coalesce", fold_case=False,
        segment_split="each", compound="four_branch", aliases="short",
        rounding="int_half_even", order_by_id=True,
    ),
    # four disjoint filters over an OR join, unioned
    "split_union": MatchPolicy(
        name="split_union", street_key="either", label_column="alt_label",
        compound="same_side", group="per_id_year",
    ),
    # all predicates inside one join condition
    "either_side": MatchPolicy(
        name="either_side", street_key="either", label_column="alt_label",
        compound="either_side", group="per_id_year",
    ),
    # Python row predicate, then dedup by (segment, ticket)
    "row_predicate": MatchPolicy(
        name="row_predicate", street_key="either", compound="wrong_high",
        dedup="id_ticket",
    ),
    # pure-RDD join on the full name, dedup by (segment, ticket, year) per side
    "distinct_ticket": MatchPolicy(
        name="distinct_ticket", street_key="full", compound="same_side",
        dedup="id_ticket_year_side", aliases="short", rounding="2dp",
    ),
    # sides unpivoted, side flag as a join key
    "side_unpivot": MatchPolicy(
        name="side_unpivot", street_key="full", ticket_split="strict_tuple",
        segment_split="strict_zero", compound="zero_default",
        spine="left_parsed_ids", aliases="short", rounding="2dp", order_by_id=True,
    ),
    "canonical": MatchPolicy(),
}


def preset(name: str, **overrides) -> MatchPolicy:
    """Look up a preset by name and apply keyword overrides."""
    try:
        base = PRESETS[name]
    except KeyError:
        raise KeyError(f"unknown preset {name!r}; known: {sorted(PRESETS)}") from None
    return base.with_(**overrides) if overrides else base
