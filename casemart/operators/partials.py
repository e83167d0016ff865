"""Additive partials over several groupings at once, and their maintenance by signed changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

CELL = "cell"


def fold(
    df: DataFrame, groupings: Mapping[str, Sequence[str]], measures: Mapping[str, Column]
) -> DataFrame:
    """(cell, all key columns, measures) of every grouping, from one scan of `df`.

    One aggregate over grouping sets: each row is expanded in memory, once per grouping, and folded
    map-side, so what is shuffled is one row per group and task. `cell` names the grouping; keys of
    other groupings are NULL. Measures must be sums or counts.
    """
    keys = list(dict.fromkeys(k for cols in groupings.values() for k in cols))
    grouped = df.groupingSets([[F.col(k) for k in cols] for cols in groupings.values()], *keys)
    counted = grouped.agg(
        F.grouping_id().alias("_id"), *(c.alias(name) for name, c in measures.items())
    )
    # Bit by bit from the first key: 1 if the key is not part of the grouping.
    ids = {
        name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
        for name, cols in groupings.items()
    }
    cell = F.coalesce(*(F.when(F.col("_id") == n, F.lit(name)) for name, n in ids.items()))
    return counted.select(cell.alias(CELL), *keys, *measures)


def changed(
    old: DataFrame, added: DataFrame, removed: DataFrame, measures: Sequence[str], rows: str
) -> DataFrame:
    """`old` partials plus those of `added` rows, less those of `removed` ones.

    All three are results of `fold` with the same keys and measures; groups whose count `rows`
    falls to 0 go. Reads the partials and the changes, never the rows that stayed.
    """
    keys = [c for c in old.columns if c not in measures]
    minus = removed.select(*keys, *((-F.col(m)).alias(m) for m in measures))
    united = old.unionByName(added).unionByName(minus)
    return (
        united.groupBy(*keys)
        .agg(*(F.sum(m).alias(m) for m in measures))
        .filter(F.col(rows) != 0)
        .select(*old.columns)
    )
