"""DataFrame operators: ticket normalisation, segment sides, matching, counting."""

from curbline.operators.counting import (
    count_per_id_year,
    dedup_matches,
    explode_per_year,
    one_hot_vector_sum,
    spine_union_zero,
    spine_zero_fill,
    yearly_pivot,
    yearly_pivot_per_id_year,
    yearly_vector,
)
from curbline.operators.matching import match_pairs
from curbline.operators.segments import parsed_sides, segment_sides, segment_spine
from curbline.operators.tickets import normalize_tickets

__all__ = [
    "count_per_id_year", "dedup_matches", "explode_per_year", "match_pairs", "normalize_tickets",
    "one_hot_vector_sum", "parsed_sides", "segment_sides", "segment_spine", "spine_union_zero",
    "spine_zero_fill", "yearly_pivot", "yearly_pivot_per_id_year", "yearly_vector",
]
