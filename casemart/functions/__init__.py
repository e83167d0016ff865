"""Column -> Column helpers. All are built-in expressions, so they stay inside codegen."""

from casemart.functions.bands import (
    band_start,
    decade_band,
    fixed_band,
    label_null,
    month_label,
    month_of,
    months_between,
)
from casemart.functions.numbers import days_between, mean_of, percent, round_half_even
from casemart.functions.parsing import (
    age_years,
    is_blank,
    null_if,
    parse_date,
    parse_date_lenient,
    parse_int,
    yes_no,
    yes_no_nullable,
)

__all__ = [
    "age_years",
    "band_start",
    "days_between",
    "decade_band",
    "fixed_band",
    "is_blank",
    "label_null",
    "mean_of",
    "month_label",
    "month_of",
    "months_between",
    "null_if",
    "parse_date",
    "parse_date_lenient",
    "parse_int",
    "percent",
    "round_half_even",
    "yes_no",
    "yes_no_nullable",
]
