"""Incremental load by content: a manifest of files knows what a delivery holds, not only its name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.sources.raw import LINE_SCHEMA, fitting, rejected
from casemart.sources.records import numbered_lines, read_raw_records
from casemart.sources.tables import delete_folder, matching, write_and_read

MANIFEST = "content string, load string, path string, length long, modified timestamp"
VERSIONS_KEPT = 2


class ContentTable:
    """The raw records of a landing folder, each content once, below `path`.

    The manifest has a row per live file: path, length, time, the hash of its content, and the load
    that holds it; and a row without a path for a content whose files have left the landing folder.
    A run lists the folder, reads only files that are not in the manifest as they are, and loads
    only contents that are not stored. So a file delivered again under another name adds
    nothing, and one changed in place takes the place of its earlier content. Rows count only once
    the manifest names their load: a run that fails before that leaves no trace but a folder.

    The hash adds up hashes of the lines, so it is folded like any sum and files of any size are
    split over tasks; files with the same lines in another order count as the same content.
    """

    def __init__(self, spark: SparkSession, src_dir: str, path: str, pattern: str = "*.csv"):
        self.spark, self.src_dir, self.pattern = spark, src_dir, pattern
        self.path = path.rstrip("/")

    def _versions(self) -> list[str]:
        found = matching(self.spark, f"{self.path}/manifest/*/_SUCCESS")
        return [p.removesuffix("/_SUCCESS") for p in found]

    def manifest(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(versions[-1])

    def _listing(self) -> DataFrame:
        files = (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", self.pattern)
            .option("recursiveFileLookup", "true")
            .load(self.src_dir)
        )
        return files.select(
            F.col("_metadata.file_path").alias("path"), "length",
            F.col("modificationTime").alias("modified"),
        )

    def _contents(self, paths: list[str]) -> DataFrame:
        """(path, content) of files; a file without a line has the content `empty`."""
        lines = numbered_lines(self.spark, paths)
        wide = F.xxhash64("value").cast("decimal(38,0)")
        return lines.groupBy(F.col("file").alias("path")).agg(
            F.sha2(
                F.concat_ws(
                    ":", F.count(F.lit(1)), F.sum(wide), F.bit_xor(F.xxhash64(F.lit(1), "value")),
                    F.sum(F.length("value")),
                ),
                256,
            ).alias("content")
        )

    def load(self) -> DataFrame:
        """Bring the table up to date and return all raw cases."""
        old, listed = self.manifest(), self._listing()
        number = len(self._versions()) and int(self._versions()[-1].rsplit("/", 1)[1]) + 1
        work = f"{self.path}/work/{uuid.uuid4().hex}"
        live = write_and_read(
            listed.join(
                old.filter("path is not null").drop("load"), ["path", "length", "modified"], "left"
            ),
            f"{work}/listing",
        )
        # The names of files to read; Spark's own listing of them is as long.
        fresh = [r.path for r in live.filter("content is null").select("path").collect()]
        if fresh:
            read = self._contents(fresh).withColumnRenamed("content", "_read")
            live = live.join(read, "path", "left").withColumn(
                "content", F.coalesce("content", "_read", F.lit("empty"))
            ).drop("_read")
        live = write_and_read(live.select("path", "length", "modified", "content"), f"{work}/live")
        held = old.select("content", "load").distinct()
        load = uuid.uuid4().hex
        new = write_and_read(
            live.join(held, "content", "left_anti")
            .filter("content <> 'empty'")
            .groupBy("content")
            .agg(F.min("path").alias("file"))
            .withColumn("load", F.lit(load)),
            f"{work}/new",
        )
        names = [r.file for r in new.select("file").collect()]  # among the files just read
        if names:
            records = read_raw_records(self.spark, names, with_file=True)
            records.join(new.select("file", "content"), "file").drop("file").write.partitionBy(
                "content"
            ).parquet(f"{self.path}/records/load={load}")
        stored = held.unionByName(new.select("content", "load"))
        # Contents whose file was changed in place go, unless another file holds them still.
        replaced = (
            old.filter("path is not null")
            .join(live.select("path", F.col("content").alias("_now")), "path")
            .filter("content <> _now")
            .select("content")
            .join(live, "content", "left_anti")
        )
        known = live.join(stored, "content", "left")
        left = (
            stored.join(live, "content", "left_anti")
            .join(replaced, "content", "left_anti")
            .withColumn("path", F.lit(None).cast("string"))
        )
        columns = ["content", "load", "path", "length", "modified"]
        known.select(*columns).unionByName(left, allowMissingColumns=True).coalesce(1).write.parquet(
            f"{self.path}/manifest/{number:08d}"
        )
        delete_folder(self.spark, work)
        for version in self._versions()[:-VERSIONS_KEPT]:
            delete_folder(self.spark, version)
        return self.cases()

    def _records(self) -> DataFrame:
        held = self.manifest().filter("load is not null").select("load", "content").distinct()
        fields = ", ".join(f"`{f.name}` string" for f in LINE_SCHEMA.fields)
        if not matching(self.spark, f"{self.path}/records/load=*"):
            return self.spark.createDataFrame([], fields)
        rows = self.spark.read.schema(f"{fields}, load string, content string").parquet(
            f"{self.path}/records"
        )
        return rows.join(held, ["load", "content"], "left_semi").drop("load", "content")

    def cases(self) -> DataFrame:
        return fitting(self._records())

    def rejected(self) -> DataFrame:
        return rejected(self._records())

    def clean(self) -> None:
        """Delete the rows of contents that the manifest no longer names; no reader may need them."""
        held = {(r.load, r.content) for r in self.manifest().select("load", "content").distinct().collect()}
        for folder in matching(self.spark, f"{self.path}/records/load=*/content=*"):
            load, content = (part.split("=")[1] for part in folder.rsplit("/", 2)[1:])
            if (load, content) not in held:
                delete_folder(self.spark, folder)
