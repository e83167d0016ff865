"""Counts, rates, means and shares per group.

Everything is a sum or a count, so each map task forwards one small row per group and a group
that holds most of the rows is no heavier to reduce than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from casemart.functions import mean_of, percent


@dataclass(frozen=True)
class Summary:
    """What to compute per group.

    total: name of the row count, or None to leave it out of the result
    flags: result name -> boolean column to count
    rates: result name -> name in `flags`; its count as a percentage of the row count
    means: result name -> numeric column to average, NULLs ignored
    null_as_zero: a group whose flags are all NULL counts 0 instead of NULL
    columns: result columns after the keys; default is total, flags, means, rates
    """

    total: str | None = "total_casos"
    flags: Mapping[str, str] = field(default_factory=dict)
    rates: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    null_as_zero: bool = False
    rate_digits: int = 2
    mean_digits: int | None = 2
    columns: Sequence[str] | None = None

    def partials(self) -> list[Column]:
        """Aggregates that can be added up again over groups of groups."""
        out = [F.count(F.lit(1)).alias("_total")]
        for name, flag in self.flags.items():
            counted = F.count_if(flag) if self.null_as_zero else F.sum(F.col(flag).cast("int"))
            out.append(counted.alias(name))
        for name, column in self.means.items():
            out += [F.sum(column).alias(f"_sum_{name}"), F.count(column).alias(f"_n_{name}")]
        return out

    def merged(self) -> list[Column]:
        names = ["_total", *self.flags]
        for name in self.means:
            names += [f"_sum_{name}", f"_n_{name}"]
        return [F.sum(n).alias(n) for n in names]

    def over(self, df: DataFrame) -> list[Column]:
        """The aggregates for rows, or for partials of this summary (they have a `_total`)."""
        return self.merged() if "_total" in df.columns else self.partials()

    def finish(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        made: dict[str, Column] = {}
        if self.total:
            made[self.total] = F.col("_total")
        made.update({name: F.col(name) for name in self.flags})
        for name in self.means:
            made[name] = mean_of(f"_sum_{name}", f"_n_{name}", self.mean_digits)
        for name, flag in self.rates.items():
            made[name] = percent(flag, "_total", self.rate_digits)
        order = self.columns or list(made)
        return df.select(*keys, *(made[c].alias(c) for c in order))


def summarise(df: DataFrame, keys: Sequence[str], summary: Summary) -> DataFrame:
    """Of rows, or of partials that were folded by finer keys before."""
    return summary.finish(df.groupBy(*keys).agg(*summary.over(df)), keys)


def summarise_by_dimension(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    label: str,
    summary: Summary,
    how: str = "left",
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Summarise by a dimension's `label`, reached through `key`.

    Same result as joining every row to the dimension and grouping by the label, also when the
    dimension repeats a key or a label. Rows are folded per key first, so the join and its
    shuffle see one row per key instead of one per case.
    """
    folded = df.groupBy(key, *extra_keys).agg(*summary.over(df))
    named = folded.join(dim.select(key, label), key, how)
    merged = named.groupBy(label, *extra_keys).agg(*summary.merged())
    return summary.finish(merged, [label, *extra_keys])


def group_counts(df: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def flag_counts(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, str],
    null_as_zero: bool = False,
    total: str = "n",
) -> DataFrame:
    """Rows and true flags per group. A group without any non-NULL flag gives NULL or 0."""
    return summarise(df, keys, Summary(total=total, flags=flags, null_as_zero=null_as_zero))


def rate_by_group(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, str],
    digits: int = 2,
    null_as_zero: bool = False,
    total: str = "n",
) -> DataFrame:
    """`flag_counts` plus, for each flag, `<name>_pct` of the group's rows."""
    rates = {f"{name}_pct": name for name in flags}
    return summarise(
        df,
        keys,
        Summary(
            total=total, flags=flags, rates=rates, rate_digits=digits, null_as_zero=null_as_zero
        ),
    )


def delay_by_group(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], digits: int | None = 2
) -> DataFrame:
    """Mean of each column per group, NULLs ignored."""
    return summarise(df, keys, Summary(total=None, means=cols, mean_digits=digits))


def with_share(
    groups: DataFrame, part: str, name: str, digits: int, of: str | None = None
) -> DataFrame:
    """Add `part` as a percentage of the sum of `of` (by default `part`) over all groups.

    The total sums the grouped rows in a scalar subquery, so Spark reuses the groups' exchange:
    the input is scanned once, there is no driver round trip and no window over all groups.
    """
    total = groups.agg(F.sum(of or part)).scalar()
    return groups.withColumn(name, percent(F.col(part), total, digits))


def share_of_total(
    df: DataFrame, keys: Sequence[str], digits: int = 2, n: str = "n", name: str = "pct_of_total"
) -> DataFrame:
    """Rows per group and their share of all rows."""
    return with_share(group_counts(df, keys, n), n, name, digits)
