"""Column profiles, each from one scan of the input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from casemart.functions import is_blank, percent


def _melt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One (column, value) row per cell, values as text."""
    texts = df.select(*(F.col(c).cast("string").alias(c) for c in cols))
    return texts.unpivot([], list(cols), "column", "value")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value of each column, NULL included, most frequent first per column.

    All columns share one scan, and equal values are folded before the shuffle.
    """
    return (
        _melt(df, cols)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column", F.desc("n"), F.col("value").asc_nulls_first())
    )


def _profile_one_type(df: DataFrame, cols: Sequence[str], dtype: str, approx: bool) -> DataFrame:
    """Profile columns of one type, with values kept in that type.

    Cells carry a column number instead of its name, which keeps the shuffled rows short.
    """
    numbered = df.select(*(F.col(c).alias(str(i)) for i, c in enumerate(cols)))
    cells = numbered.unpivot([], numbered.columns, "_column", "_value")
    missing = is_blank("_value") if dtype == "string" else F.col("_value").isNull()
    if approx:
        has_null = F.bool_or(F.col("_value").isNull()).cast("int")
        stats = cells.groupBy("_column").agg(
            (F.approx_count_distinct("_value") + has_null).alias("n_distinct"),
            F.count_if(missing).alias("n_missing"),
            F.count(F.lit(1)).alias("_rows"),
        )
    else:
        stats = (
            cells.groupBy("_column", "_value")
            .agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("_column")
            .agg(
                F.count(F.lit(1)).alias("n_distinct"),
                F.sum(F.when(missing, F.col("_n")).otherwise(F.lit(0))).alias("n_missing"),
                F.sum("_n").alias("_rows"),
            )
        )
    names = F.array(*(F.lit(c) for c in cols))
    return stats.select(
        F.get(names, F.col("_column").cast("int")).alias("column"),
        "n_distinct",
        "n_missing",
        percent("n_missing", "_rows", 1).alias("pct_missing"),
    )


def profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: n_distinct (NULL counts as a value), n_missing (NULL or empty), pct_missing.

    Exact distinct counts fold the cells in two levels, first per (column, value), then per
    column, so frequent values never travel. Columns are grouped by type; each group reads only
    its own columns, so together they read the input once. `approx=True` replaces the shuffle
    of distinct values by a fixed-size sketch per column, where an estimate is enough.
    """
    wanted = set(cols or df.columns)
    by_type: dict[str, list[str]] = {}
    for name, dtype in df.dtypes:
        if name in wanted:
            by_type.setdefault(dtype, []).append(name)
    parts = [_profile_one_type(df, names, t, approx) for t, names in by_type.items()]
    return reduce(DataFrame.unionByName, parts)


def null_audit(df: DataFrame) -> DataFrame:
    """Columns that hold at least one NULL, with count and share; one aggregate for all."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns),
    )
    return (
        counted.unpivot(["_rows"], df.columns, "column", "n_null")
        .filter(F.col("n_null") > 0)
        .select("column", "n_null", percent("n_null", "_rows", 1).alias("pct_null"))
    )
