"""Column profiles that grow by loads: mergeable sketches of each load, united when read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.functions import is_blank, percent
from casemart.sources.tables import matching

LOG_SLOTS = 14  # distinct counts: 2**14 registers, relative standard error under 1 %
TRACKED = 4096  # frequent values: counts are exact while a column has at most 3/4 as many values
# What a frequent-items sketch of text is stored as: a fixed value.
TOP_TYPE = "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"


class ProfileStore:
    """Sketches of the named columns for every load below `path`.

    A load leaves one row per column: rows, missing and NULL cells, a distinct-count sketch, and a
    frequent-items sketch for the columns in `frequent`. Its size depends on the number of columns
    alone. Reading unites the rows of all loads, so rows loaded before are never read again. A load
    is kept under its own name: repeated after a failure it takes its own place and counts once.

    Values are compared as text, like in `value_counts`. `profile` estimates distinct counts; rows
    and missing cells are exact. `value_counts` is exact while a column's distinct values stay within
    3/4 of `tracked`; beyond that the most frequent values are estimated. A store without a load has
    no rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        columns: Sequence[str],
        frequent: Sequence[str] = (),
        tracked: int = TRACKED,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns, self.frequent, self.tracked = list(columns), list(frequent), tracked

    def add(self, df: DataFrame, name: str) -> None:
        """Sketch a load. All columns come from one scan, folded to one row by each task."""
        folded = [F.count(F.lit(1)).alias("n_rows")]
        tops = {}
        for i, c in enumerate(self.columns):
            value = F.col(c).cast("string")
            folded += [
                F.count_if(is_blank(value)).alias(f"missing{i}"),
                F.count_if(F.col(c).isNull()).alias(f"null{i}"),
                F.hll_sketch_agg(value, LOG_SLOTS).alias(f"distinct{i}"),
            ]
            if c in self.frequent:
                top = F.call_function("approx_top_k_accumulate", value, F.lit(self.tracked))
                folded.append(top.alias(f"top{i}"))
                tops[i] = F.col(f"top{i}")
        cells = [
            F.struct(
                F.lit(c).alias("column"),
                "n_rows",
                F.col(f"missing{i}").alias("n_missing"),
                F.col(f"null{i}").alias("n_null"),
                F.col(f"distinct{i}").alias("distinct_values"),
                tops.get(i, F.lit(None)).cast(TOP_TYPE).alias("top_values"),
            )
            for i, c in enumerate(self.columns)
        ]
        (
            df.agg(*folded)
            .select(F.inline(F.array(*cells)))
            .write.mode("overwrite")
            .parquet(f"{self.path}/loads/{name}")
        )

    def _loads(self) -> DataFrame | None:
        done = matching(self.spark, f"{self.path}/loads/*/_SUCCESS")
        if not done:
            return None
        return self.spark.read.parquet(*(p.removesuffix("/_SUCCESS") for p in done))

    def profile(self) -> DataFrame:
        """(column, n_distinct, n_missing, pct_missing) over all loads; NULL counts as a value."""
        loads = self._loads()
        if loads is None:
            return self.spark.sql(
                """SELECT '' AS column, 0L AS n_distinct, 0L AS n_missing, 0D AS pct_missing
                WHERE false"""
            )
        united = loads.groupBy("column").agg(
            F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("_distinct"),
            F.sum("n_null").alias("_null"),
            F.sum("n_missing").alias("n_missing"),
            F.sum("n_rows").alias("_rows"),
        )
        return united.select(
            "column",
            (F.col("_distinct") + (F.col("_null") > 0).cast("long")).alias("n_distinct"),
            "n_missing",
            percent("n_missing", "_rows", 1).alias("pct_missing"),
        )

    def value_counts(self, at_most: int = 1000) -> DataFrame:
        """(column, value, n) of the `at_most` most frequent values of each frequent column."""
        loads = self._loads()
        if loads is None:
            return self.spark.sql("SELECT '' AS column, '' AS value, 0L AS n WHERE false")
        sketch = F.call_function("approx_top_k_combine", F.col("top_values"), F.lit(self.tracked))
        items = F.call_function("approx_top_k_estimate", sketch, F.lit(at_most))
        return (
            loads.filter(F.col("column").isin(self.frequent))
            .groupBy("column")
            .agg(items.alias("_items"))
            .select("column", F.inline("_items").alias("value", "n"))
        )
