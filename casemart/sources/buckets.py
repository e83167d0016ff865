"""One row per key, kept in hash buckets and brought up to date by deliveries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.sources.tables import delete_folder, matching

BUCKET, NEW = "_bucket", "_new"
# Keys that are broadcast to the stored rows; more of them meet in a merge join.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Change:
    """The rows that a delivery put in, and the stored rows whose place they took."""

    added: DataFrame
    removed: DataFrame


class BucketStore:
    """Rows with unique keys below `path`, one partition folder per bucket of the key's hash.

    A delivery is merged into the buckets its keys fall into; the others are neither read nor
    written. Merging has two steps. The new content of the touched buckets and the change are
    written aside under the delivery's name; the mark `staged` ends that step. Then the buckets are
    replaced from there; the mark `done` ends that one. A merge that failed is repeated under the
    same name: before the first mark it starts again from the untouched store, after it only the
    second step runs, which may run twice; a merge that is done stays as it is. A staged merge that
    was never repeated is finished before the next one. One merge runs at a time, and readers should
    not overlap it.

    `pick` reduces rows of several origins to one per key; equal rows must come out the same
    whatever the order of deliveries.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        schema,
        pick: Callable[[DataFrame, Sequence[Column]], DataFrame],
        buckets: int = 1024,
    ):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        self.pick, self.buckets = pick, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _hadoop(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        system, where = self._hadoop(path)
        return system.exists(where)

    def _mark(self, path: str) -> None:
        system, where = self._hadoop(path)
        system.create(where, True).close()

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _columns(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)

    def _stored(self) -> DataFrame:
        """The stored rows with their bucket."""
        schema = f"{self._columns()}, {BUCKET} int"
        if not self._exists(f"{self.path}/rows"):
            return self.spark.createDataFrame([], schema)
        return self._read(f"{self.path}/rows", schema)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def change(self, name: str) -> Change:
        """What the merge of this name changed, for as long as its folder is kept."""
        aside = f"{self.path}/merges/{name}"
        staged = self._read(f"{aside}/rows", f"{self._columns()}, {NEW} boolean, {BUCKET} int")
        return Change(
            staged.filter(NEW).drop(NEW, BUCKET), self._read(f"{aside}/removed", self._columns())
        )

    def merge(self, delivery: DataFrame, name: str) -> Change:
        """Merge a delivery; `name` is the delivery's own, the same when it is repeated."""
        aside, done = f"{self.path}/merges/{name}", f"{self.path}/done/{name}"
        if not self._exists(done):
            self._finish_others(name)
            if not self._exists(f"{aside}/staged"):
                self._stage(delivery, aside)
                self._mark(f"{aside}/staged")
            self._finish(name)
        return self.change(name)

    def _finish(self, name: str) -> None:
        self._replace(f"{self.path}/merges/{name}")
        self._mark(f"{self.path}/done/{name}")
        delete_folder(self.spark, f"{self.path}/merges/{name}/staged")

    def _finish_others(self, name: str) -> None:
        for path in matching(self.spark, f"{self.path}/merges/*/staged"):
            other = path.rsplit("/", 2)[1]
            if other != name:
                self._finish(other)

    def _stage(self, delivery: DataFrame, aside: str) -> None:
        columns = [f.name for f in self.schema.fields]
        new = delivery.select(*columns, self._bucket(), F.lit(True).alias(NEW))
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most `buckets`
        old = self._stored().filter(F.col(BUCKET).isin(touched)).withColumn(NEW, F.lit(False))
        # Of equal rows the stored one stays, so a repeated row is no change.
        kept = self.pick(old.unionByName(new), [F.col(NEW)])
        kept.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{aside}/rows")
        staged = self._read(f"{aside}/rows", f"{self._columns()}, {NEW} boolean, {BUCKET} int")
        lost = self._lost(old, staged.filter(NEW))
        lost.select(*columns).write.mode("overwrite").parquet(f"{aside}/removed")

    def _lost(self, old: DataFrame, won: DataFrame) -> DataFrame:
        """The stored rows whose keys new rows have won.

        Spark takes the winners for a few columns' share of the compressed files and would broadcast
        millions of keys, so they are counted and the join is named.
        """
        winners = won.count() if self._exists(f"{self.path}/rows") else 0
        if not winners:
            return old.filter(F.lit(False))
        keys = won.select(F.col(self.key).alias("_key"), F.col(BUCKET).alias("_at"))
        same = (F.col(BUCKET) == F.col("_at")) & F.col(self.key).eqNullSafe(F.col("_key"))
        how = "broadcast" if winners <= BROADCAST_KEYS else "merge"
        return old.join(keys.hint(how), same, "left_semi")

    def _replace(self, aside: str) -> None:
        staged = self._read(f"{aside}/rows", f"{self._columns()}, {NEW} boolean, {BUCKET} int")
        (
            staged.drop(NEW)
            .repartition(BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(f"{self.path}/rows")
        )
