"""Write, audit, publish: a version becomes visible only if its checks pass, and the old one stays."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casemart.sources.tables import database_path, delete_folder, matching

KEEP_SECONDS = 24 * 3600.0  # how long a replaced version stays for those who still read it
PUBLISHED = "_published"

Audit = Callable[[DataFrame], DataFrame]


class AuditFailed(Exception):
    """The staged version did not pass; the published one is as it was. `folder` holds the rows."""

    def __init__(self, name: str, folder: str, failed: list):
        said = ", ".join(f"{r.check} {r.column}: {r.violations}" for r in failed)
        super().__init__(f"{name} is not published ({said}); staged in {folder}")
        self.folder, self.failed = folder, failed


def publish(
    df: DataFrame,
    name: str,
    audit: Audit | None = None,
    path: str | None = None,
    keep_seconds: float = KEEP_SECONDS,
) -> DataFrame:
    """Publish `df` as the next version of `name` and return a scan of it.

    The rows are written to a folder of their own. `audit` gets a scan of them and returns a report
    with the columns check, column, violations and passed, one row per check. Only if all have
    passed does `name` move, in one catalog call, whether or not the columns are still the same: it
    is a view of the folder. Files of replaced versions stay for `keep_seconds`, so a reader
    that started before a refresh ends as it began; versions replaced earlier than that go.
    """
    spark = df.sparkSession
    path = (path or f"{database_path(spark, name)}_published").rstrip("/")
    folder = f"{path}/{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(folder)
    staged = spark.read.schema(df.schema).parquet(folder)
    if audit is not None:
        failed = [r for r in audit(staged).collect() if not r.passed]
        if failed:
            raise AuditFailed(name, folder, failed)
    _mark(spark, folder)
    _point(spark, name, folder)
    expire(spark, path, keep_seconds)
    return spark.table(name)


def _mark(spark: SparkSession, folder: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{PUBLISHED}")
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.create(where, True).close()


def _point(spark: SparkSession, name: str, folder: str) -> None:
    known = spark.catalog.tableExists(name)
    if known and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; publish under a name of its own")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")


def expire(
    spark: SparkSession, path: str, keep_seconds: float, now: float | None = None
) -> list[str]:
    """Delete versions replaced, and failed ones staged, more than `keep_seconds` ago."""
    now = time.time() if now is None else now
    published = {p.rsplit("/", 1)[0] for p in matching(spark, f"{path}/*/{PUBLISHED}")}
    folders = matching(spark, f"{path}/*")

    def made(folder: str) -> float:
        return int(folder.rsplit("/", 1)[1].split("-")[0]) / 1000

    gone = []
    for folder in folders:
        after = [made(f) for f in published if made(f) > made(folder)]
        replaced = min(after, default=None)
        if folder not in published and replaced is None:
            continue  # being written, or the last one to fail
        if replaced is not None and now - replaced > keep_seconds:
            delete_folder(spark, folder)
            gone.append(folder)
    return gone
