"""Age bands, months and NULL labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from casemart.schema import AGE_BAND_STARTS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_band(c: Column | str, starts: Sequence[int] = AGE_BAND_STARTS) -> Column:
    """Bands `0-9`, `10-19`, ... with an open last one (`80+`); NULL stays NULL.

    Values under the first start belong to the first band.
    """
    value = _col(c)
    band = F.when(value >= F.lit(starts[-1]), F.lit(f"{starts[-1]}+"))
    for low, high in zip(reversed(starts[1:-1]), reversed(starts[2:])):
        band = band.when(value >= F.lit(low), F.lit(f"{low}-{high - 1}"))
    return band.when(value.isNotNull(), F.lit(f"{starts[0]}-{starts[1] - 1}"))


def decade_band(c: Column | str, null_label: str | None = None) -> Column:
    """Open-ended decades as text, `30-39`; NULL stays NULL unless a label is given."""
    start = F.floor(_col(c) / F.lit(10)) * F.lit(10)
    band = F.concat_ws("-", start.cast("string"), (start + F.lit(9)).cast("string"))
    return F.when(_col(c).isNotNull(), band).otherwise(F.lit(null_label).cast("string"))


def band_start(c: Column | str) -> Column:
    """First number of a band label, `30-39` -> 30."""
    return F.split_part(_col(c), F.lit("-"), F.lit(1)).try_cast("int")


def month_of(c: Column | str) -> Column:
    """First instant of the month, zone-free so results do not move with the session zone."""
    return F.trunc(_col(c), "month").cast("timestamp_ntz")


def month_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def months_between(first: str, last: str) -> list[str]:
    """Month labels from `first` to `last`, both `YYYY-MM` and included."""
    low, high = (int(m[:4]) * 12 + int(m[5:]) - 1 for m in (first, last))
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(low, high + 1)]


def label_null(c: Column | str, label: str) -> Column:
    return F.coalesce(_col(c), F.lit(label))
