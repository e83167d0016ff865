"""Dimension keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from casemart.sources import shared_dir, write_and_read


def distinct_rows(df: DataFrame, columns: Sequence[str], required: str) -> DataFrame:
    """Distinct `columns` of the rows that have a value in `required`."""
    return df.filter(F.col(required).isNotNull()).select(*columns).distinct()


def any_value_per_group(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One value of `column` per key: the smallest, ignoring NULL.

    The input is first folded to its distinct rows with a hash aggregate; a direct `min` of a
    text column would sort every input row instead. The `min` reads the fold's count, without
    which the optimizer would merge both steps into that one sort.
    """
    seen = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    value = F.when(F.col("_n") > 0, F.col(column))
    return seen.groupBy(*keys).agg(F.min(value).alias(column))


def with_surrogate_key(df: DataFrame, order_cols: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in the order of `order_cols`; the same in every run.

    Rows are cut into ranges of all order columns together, so one frequent lead value is spread
    like any other. Each range is numbered by itself and shifted by the rows of the ranges before
    it; only those counts, one per range, meet in one task. The ranges are written to the shared
    folder first: their borders come from a sample and must not change between the two reads.
    """
    spark = df.sparkSession
    order = [F.col(c).asc() for c in order_cols]
    ranges = write_and_read(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
        f"{shared_dir(spark)}/keys/{uuid.uuid4().hex}",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = ranges.groupBy(F.col("_range").alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", (F.sum("_size").over(before) - F.col("_size")).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranges.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, F.col("_range") == F.col("_part"))
        .withColumn(name, F.col("_offset") + F.col("_rank"))
        .drop("_rank", "_range", "_part", "_offset")
    )
