"""Full-refresh tables, written intermediate layers, and the bounded client hand-off."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate results that the driver and every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset it lies in the
    warehouse, which holds tables and so is shared as well; never in a machine's own folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def write_and_read(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to `path` and return a scan of it: cuts the lineage and gives true sizes.

    `sort_by` sorts inside each file, so a filter on those columns skips whole row groups.
    """
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file byte by byte; an existing target is replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    systems = [p.getFileSystem(conf) for p in paths]
    jvm.org.apache.hadoop.fs.FileUtil.copy(
        systems[0], paths[0], systems[1], paths[1], False, True, conf
    )


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order, on whatever file system holds them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [])


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows}


def database_path(spark: SparkSession, name: str) -> str:
    """Where the database of a table keeps it."""
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    rows = spark.sql(f"DESCRIBE DATABASE {database}").collect()
    return f"{ {r[0]: r[1] for r in rows}['Location'] }/{table}"


def save_mart(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace table `name`, rows and schema, and return it as a table scan.

    The new rows are written to a folder of their own below `path` (by default beside the
    database's tables); only then is the table pointed at it, and the old files go last. So a
    refresh that fails leaves the old table as it was, and `df` may read the table itself.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{database_path(spark, name)}_versions"
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.format("parquet").save(folder)
    old = None
    if spark.catalog.tableExists(name):
        old = _details(spark, name).get("Location")
        if spark.table(name).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    if old:
        delete_folder(spark, old)
    return spark.table(name)


def replace_table(
    spark: SparkSession, name: str, change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Replace a table by a frame derived from that table itself."""
    return save_mart(change(spark.table(name)), name)


LISTED_BY_DRIVER = 2000  # files; more are listed by a Spark job


def file_version(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Number, size and a hash of names, lengths and times of all files below `paths`.

    Asked of the file system that holds them, also for files in subfolders; a few files cost the
    driver a few calls and no job, many are listed by Spark.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    roots = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    systems = [root.getFileSystem(hadoop) for root in roots]
    if sum(s.getContentSummary(r).getFileCount() for s, r in zip(systems, roots)) <= LISTED_BY_DRIVER:
        stamps = []
        for system, root in zip(systems, roots):
            files = system.listFiles(root, True)
            while files.hasNext():
                f = files.next()
                name = f.getPath().getName()
                if not name.startswith(("_", ".")):
                    stamps.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        digest = hashlib.sha256(repr(sorted(stamps)).encode()).hexdigest()
        return len(stamps), sum(length for _, length, _ in stamps), digest
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    )
    stamp = F.xxhash64("path", "length", "modificationTime")
    return tuple(
        files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.bit_xor(stamp)).first()
    )


def export_mart(df: DataFrame, max_rows: int = 10_000):
    """A small mart as a pandas frame. Larger results raise instead of being cut silently."""
    out = df.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ValueError(f"more than {max_rows} rows; write the result as a table instead")
    return out
