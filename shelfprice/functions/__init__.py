from shelfprice.functions.dates import (
    date_key,
    guarded_date,
    month_key,
    week_start,
)
from shelfprice.functions.keys import UNMATCHED, UNMATCHED_INT, surrogate_key, unmatched, unmatched_int
from shelfprice.functions.numbers import (
    fill_outlier_with_avg,
    guarded_double,
    guarded_int,
    money,
    nan_to_null,
    price_fallback,
)
from shelfprice.functions.text import (
    clean_title_case,
    clean_title_cases,
    clean_with_pattern,
    handle_not_applicable,
    map_store_region,
    title,
    validate_allowed_values,
)

__all__ = [
    "UNMATCHED",
    "UNMATCHED_INT",
    "clean_title_case",
    "clean_title_cases",
    "clean_with_pattern",
    "date_key",
    "fill_outlier_with_avg",
    "guarded_date",
    "guarded_double",
    "guarded_int",
    "handle_not_applicable",
    "map_store_region",
    "money",
    "month_key",
    "nan_to_null",
    "price_fallback",
    "surrogate_key",
    "title",
    "unmatched",
    "unmatched_int",
    "validate_allowed_values",
    "week_start",
]
