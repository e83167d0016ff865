"""Data-quality checks. A check returns its violations; none means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """`kind` is `unique` or `not_null`."""

    kind: str
    table: str
    column: str


def check_unique(df: DataFrame, cols: str | Sequence[str], null_is_key: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count.

    A single-column check skips NULL; parts of a composite key group like values. `null_is_key`
    makes NULL count as a key of its own for a single column too.
    """
    keys = [cols] if isinstance(cols, str) else list(cols)
    if len(keys) == 1 and not null_is_key:
        df = df.filter(F.col(keys[0]).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """The rows without a value in `col`."""
    return df.filter(F.col(col).isNull())


def code_collisions(df: DataFrame, code_cols: Sequence[str], name_col: str) -> DataFrame:
    """Codes that stand for several names: n_names, and n_rows under the code.

    NULL parts of the code are skipped. Rows are folded per (code, name) first, so a code that
    covers most of the table is a few rows by the time names are counted.
    """
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in code_cols))
    return (
        df.filter(known)
        .groupBy(*code_cols, name_col)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*code_cols)
        .agg(F.count(name_col).alias("n_names"), F.sum("_n").alias("n_rows"))
        .filter(F.col("n_names") > 1)
    )


def _table_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table: one pass, plus one more per further unique column."""
    unique = [c.column for c in checks if c.kind == "unique"]
    not_null = [c.column for c in checks if c.kind == "not_null"]
    nulls = {c: F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in not_null}

    def unique_pass(column: str, with_nulls: bool) -> DataFrame:
        carried = list(nulls.values()) if with_nulls else []
        keys = df.groupBy(F.col(column).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), *carried
        )
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))
        sums = [
            F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"not_null:{c}")
            for c in (not_null if with_nulls else [])
        ]
        return keys.agg(repeated.alias(f"unique:{column}"), *sums)

    passes = [unique_pass(c, i == 0) for i, c in enumerate(unique)]
    if not unique:
        passes = [df.agg(*(nulls[c].alias(f"not_null:{c}") for c in not_null))]
    longs = [p.unpivot([], p.columns, "check_column", "violations") for p in passes]
    return reduce(DataFrame.unionByName, longs).select(
        F.split_part("check_column", F.lit(":"), F.lit(1)).alias("check"),
        F.lit(checks[0].table).alias("table"),
        F.split_part("check_column", F.lit(":"), F.lit(2)).alias("column"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report (check, table, column, violations, passed) of the whole suite."""
    names = list(dict.fromkeys(c.table for c in checks))
    reports = [_table_report(tables[t], [c for c in checks if c.table == t]) for t in names]
    return reduce(DataFrame.unionByName, reports)
