"""Rates, means and day differences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days, negative if `end` comes first, NULL if either date is missing."""
    return F.datediff(_col(end), _col(start))


def percent(part: Column | str, whole: Column | str, digits: int | None = 2) -> Column:
    """part / whole * 100 on doubles; NULL where the whole is 0 or missing."""
    rate = F.try_divide(_col(part), _col(whole)) * F.lit(100)
    return rate if digits is None else F.round(rate, digits)


def mean_of(total: Column | str, n: Column | str, digits: int | None = None) -> Column:
    """Mean from an already aggregated sum and count."""
    mean = F.try_divide(_col(total), _col(n))
    return mean if digits is None else F.round(mean, digits)


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Round on the exact binary value, ties to even (0.125 -> 0.12), as client code does."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", _col(c), F.lit(pattern)).cast("double")
