"""Column expressions: parsing/normalisation and trend."""

from curbline.functions.parsing import (
    borough_code,
    fold,
    house_first_two,
    house_number_parses,
    side_range,
    split_first_two,
    strict_int,
    strict_tuple,
    street_key_coalesce,
    year_suffix,
)
from curbline.functions.trend import apply_rounding, centred_slope_expr, row_mean_expr, slope_expr

__all__ = [
    "apply_rounding", "borough_code", "centred_slope_expr", "fold", "house_first_two", "house_number_parses",
    "row_mean_expr", "side_range", "slope_expr", "split_first_two", "strict_int", "strict_tuple",
    "street_key_coalesce", "year_suffix",
]
