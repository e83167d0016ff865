"""How a table's rows lie in its files: in buckets of a key, or clustered by two or more columns."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTS = 31  # cut points per column: ranks of at most five bits


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Table `name` at `path`, in `buckets` files by the key's hash, each sorted by the key.

    Grouping by the key or joining two such tables by it needs no shuffle, as every bucket is one
    task's. So it suits keys with few rows each, as case ids in layers after deduplication; the rows
    of a hot key would all be one task's. Rows are brought to their bucket first, so a bucket is one
    file and not one per task.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


HEAD = 64  # characters of a text that its rank may look at


def _common_starts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """For text columns: how many first characters all values share, as the outermost two do."""
    texts = [c for c, kind in df.select(*columns).dtypes if kind == "string"]
    if not texts:
        return {}
    heads = [F.substring(c, 1, HEAD) for c in texts]
    found = df.agg(*(F.min(h) for h in heads), *(F.max(h) for h in heads)).first()
    return {
        c: len(os.path.commonprefix([found[i] or "", found[i + len(texts)] or ""]))
        for i, c in enumerate(texts)
    }


def _number(column: str, dtype: str, skip: int) -> Column:
    """An order-preserving number: text by six bytes behind the shared start, all else by value."""
    if dtype == "string":
        text = F.substring(F.encode(F.substring(column, skip + 1, 6), "UTF-8"), 1, 6)
        return F.conv(F.rpad(F.hex(text), 12, "0"), 16, 10).cast("double")
    if dtype == "date":
        return F.unix_date(column).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def interleaved(ranks: Sequence[tuple[Column, int]]) -> Column:
    """One number from (rank, bits) pairs: their bits in turn, the highest of each first."""
    depth = max(bits for _, bits in ranks)
    code = F.lit(0).cast("long")
    for level in range(1, depth + 1):
        for rank, bits in ranks:
            if level <= bits:
                bit = F.shiftright(rank, bits - level).bitwiseAND(1).cast("long")
                code = F.shiftleft(code, 1).bitwiseOR(bit)
    return code


def cluster_by(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """`df` in `files` ranges of the interleaved bits of the columns' ranks, sorted inside each.

    A filter on any of the columns then meets few files and row groups, as none of them is spread
    over the whole range. Ranks come from at most `CUTS` quantiles per column, found by aggregates
    over these columns alone; NULL ranks below all values. Only where rows lie changes, never which.
    """
    kinds = dict(df.dtypes)
    starts = _common_starts(df, columns)
    numbers = {c: _number(c, kinds[c], starts.get(c, 0)) for c in columns}
    shares = [n / (CUTS + 1) for n in range(1, CUTS + 1)]
    found = df.agg(
        *(
            F.percentile_approx(number, shares, 1000).alias(str(i))
            for i, number in enumerate(numbers.values())
        )
    ).first()
    ranks = []
    for i, number in enumerate(numbers.values()):
        cuts = sorted(set(found[i] or ()))
        rank = F.lit(0)
        for cut in cuts:
            rank = rank + F.coalesce(number >= F.lit(cut), F.lit(False)).cast("int")
        ranks.append((rank, max(1, len(cuts).bit_length())))
    placed = df.withColumn("_place", interleaved(ranks))
    order = ["_place", *columns]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place")
