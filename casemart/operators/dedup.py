"""One row per key, and audits of keys that had more than one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedup_by_priority(
    df: DataFrame,
    key: str | Sequence[str],
    priority: Sequence[Column],
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the first row of each key in the order `priority`, then `tie_breakers`.

    Without explicit tie breakers every other column breaks ties, so the survivor is the same
    in each run and after a lost executor. NULL keys form one group.

    The `row_number() = 1` filter lets Spark place a group limit under the shuffle: each map
    task forwards at most one row per key, so a key that holds a third of all rows costs one
    row per task, not one oversized reduce task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys]
    order = [*priority, *(F.col(t).asc() if isinstance(t, str) else t for t in tie_breakers)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_audit(
    df: DataFrame, key: str | Sequence[str], colocated: bool = False
) -> DataFrame:
    """Keys with more than one row: key columns, n_rows, differing_columns (comma separated).

    The repeated keys come from a pass over the key alone; only their rows are compared. A
    column differs inside a key if its smallest and largest value do, or if only some rows have
    one. Text and nested values are compared by a 64-bit hash: all buffers are then of fixed
    width, and Spark folds them in a hash table instead of sorting every row.

    The comparison groups by the key as one struct, so Spark does not tie it to the partitioning
    of the join below it. That leaves AQE free to broadcast a short list of keys or to split a
    hot one, and the rows of a hot key are folded to one per task before they meet.

    `colocated` is for tables in buckets of the key: all rows are folded where they lie, from one
    scan without a shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    repeated = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)))
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    fixed = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date",
             "timestamp", "timestamp_ntz"}
    kinds = dict(df.dtypes)
    folded = [F.count(F.lit(1)).alias("n_rows")]
    marks = []
    for i, c in enumerate(others):
        plain = kinds[c] in fixed or kinds[c].startswith("decimal")
        value = F.col(c) if plain else F.when(F.col(c).isNotNull(), F.xxhash64(c))
        folded += [F.min(value).alias(f"_lo{i}"), F.max(value).alias(f"_hi{i}"),
                   F.count(c).alias(f"_some{i}")]
        differs = (F.col(f"_lo{i}") != F.col(f"_hi{i}")) | (
            F.col(f"_some{i}").between(1, F.col("n_rows") - 1)
        )
        marks.append(F.when(differs, F.lit(c)))
    named = F.concat_ws(",", *marks).alias("differing_columns")
    if colocated:
        return df.groupBy(*keys).agg(*folded).filter("n_rows > 1").select(*keys, "n_rows", named)
    return (
        df.join(repeated, reduce(Column.__and__, same_key), "left_semi")
        .groupBy(F.struct(*keys).alias("_key"))
        .agg(*folded)
        .select("_key.*", "n_rows", named)
    )


def step_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Row counts before and after deduplication by `key`, from one pass over the key alone."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
            F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
        )
    )
