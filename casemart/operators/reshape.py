"""Sorts, previews, long and wide forms, and the merge of two summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def top_n(df: DataFrame, by: str, n: int = 20, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest `by`; `ties` makes the cut the same in every run."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def sort_nulls_last(df: DataFrame, *cols: str) -> DataFrame:
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in cols))


def long_form(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per id and metric; values become double so that mixed types fit one column."""
    cast = df.select(*ids, *(F.col(m).cast("double").alias(m) for m in metrics))
    return cast.unpivot(list(ids), list(metrics), name, value)


def matrix(
    df: DataFrame,
    row: str,
    column: Column,
    values: Sequence[str],
    measure: str,
    total: str,
) -> DataFrame:
    """Cross table of sums with 0 for gaps, heaviest row first.

    `values` fixes the result columns, so the schema does not depend on the data and Spark need
    not look for the values first. `total` sums the whole row, listed in `values` or not. Cells
    are folded first, so a heavy row is a few partial sums per task.
    """
    cells = df.groupBy(F.col(row), column.alias("_column")).agg(F.sum(measure).alias("_cell"))
    columns = [
        F.coalesce(F.sum(F.when(F.col("_column") == v, F.col("_cell"))), F.lit(0)).alias(v)
        for v in values
    ]
    return (
        cells.groupBy(row)
        .agg(F.sum("_cell").alias(total), *columns)
        .orderBy(F.desc(total), row)
    )


def merge_null_safe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner merge on `key` in which NULL matches NULL; the key appears once."""
    renamed = right.withColumnRenamed(key, "_key")
    return left.join(renamed, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
