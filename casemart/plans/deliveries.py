"""Cases and marts kept up to date over deliveries, without reading what did not change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemart.functions import days_between
from casemart.operators import dedup_by_priority
from casemart.plans import clean, cube
from casemart.plans.star import DELAYS, ONSET
from casemart.schema import FUNDING_PREFERRED, RAW_COLUMNS, RAW_SCHEMA, Flavour
from casemart.sources import matching, write_and_read
from casemart.sources.buckets import BucketStore, Change

CASE = "id_evento_caso"


def _best(rows: DataFrame, last: list[Column]) -> DataFrame:
    """`clean.best_reports` over stored and delivered reports alike."""
    preferred = F.coalesce(F.col(clean.FUNDING) == F.lit(FUNDING_PREFERRED), F.lit(False))
    others = [F.col(c).asc() for c in RAW_COLUMNS if c != CASE]
    return dedup_by_priority(rows, CASE, [preferred.desc()], [*others, *last])


def report_store(spark: SparkSession, path: str, buckets: int = 1024) -> BucketStore:
    """The one raw report that stands for each case."""
    return BucketStore(spark, path, CASE, RAW_SCHEMA, _best, buckets)


def measured_cases(reports: DataFrame) -> DataFrame:
    """Confirmed flavour: what the cells need of a case, from its report alone, no dimension."""
    cases = clean.typed_cases(reports, Flavour.CONFIRMED)
    delays = {name: days_between(end, ONSET) for name, end in DELAYS.items()}
    return cases.withColumnRenamed("residencia_provincia_id", "provincia_id").withColumns(delays)


class Deliveries:
    """Survivors and cells of all deliveries so far, below `path`.

    A delivery changes the survivors of its buckets; the cells lose what replaced reports had
    added and gain what the new ones add. Each version of the cells is a numbered folder named after
    its delivery and derived from the one before; the last complete one counts. So a delivery may be
    repeated after a failure, and loading goes on where an earlier run has stopped.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024):
        self.spark, self.path = spark, path.rstrip("/")
        self.store = report_store(spark, f"{self.path}/reports", buckets)

    def _versions(self, name: str = "*") -> list[str]:
        found = matching(self.spark, f"{self.path}/cells/*-{name}/_SUCCESS")
        return [path.removesuffix("/_SUCCESS") for path in found]

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(self._versions()[-1])

    def load(self, delivery: DataFrame, name: str) -> Change:
        change = self.store.merge(delivery, name)
        if not self._versions(name):
            flavour, number = Flavour.CONFIRMED, len(self._versions())
            added, removed = (measured_cases(df) for df in (change.added, change.removed))
            if number:
                cells = cube.changed_cells(self.cells, added, removed, flavour)
            else:
                cells = cube.fold_cases(added, flavour)
            write_and_read(cells, f"{self.path}/cells/{number:08d}-{name}")
        return change

    def layers(self) -> cube.CellLayers:
        """For the marts of the confirmed flavour."""
        provinces = cube.named_provinces(self.cells, Flavour.CONFIRMED)
        return cube.CellLayers(Flavour.CONFIRMED, self.cells, provinces)

    def silver(self) -> DataFrame:
        return clean.typed_cases(self.store.read(), Flavour.CONFIRMED)
