"""Idempotent load of raw files: each file once, however often the load is run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemart.sources.raw import LINE_OPTIONS, LINE_SCHEMA, fitting, rejected

# Bytes of one micro-batch: a large backlog is loaded in steps that can each be repeated.
BATCH_BYTES = 256 << 30


def ingest_new_files(
    spark: SparkSession,
    src_dir: str,
    table_dir: str,
    checkpoint: str,
    pattern: str = "*.csv",
    max_bytes_per_batch: int = BATCH_BYTES,
    archive_dir: str | None = None,
) -> DataFrame:
    """Append the files of `src_dir` that earlier runs have not loaded; return all raw cases.

    Nothing delivered is lost: a line that does not fit the 25 columns is stored whole beside the
    cases, and `rejected_lines` returns it.

    The checkpoint's source log remembers files by path, and the sink's log makes a batch that
    is repeated after a failure count once. A file changed in place is not read again. By
    default the file source ignores files much older than the newest it has seen; the age limit
    is lifted so that a late delivery of an old file is still loaded.

    For a single file pass its folder, and its name as `pattern`. `max_bytes_per_batch` splits a
    large backlog into several commits. With `archive_dir` loaded files are moved there, so the
    landing folder, and with it each run's listing, stays short.
    """
    reader = (
        spark.readStream.schema(LINE_SCHEMA)
        .options(**LINE_OPTIONS)
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", "36500d")
    )
    reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_batch))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    query = (
        reader.csv(src_dir)
        .writeStream.format("parquet")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return fitting(_lines(spark, table_dir))


def rejected_lines(spark: SparkSession, table_dir: str) -> DataFrame:
    """The delivered lines that are no raw case."""
    return rejected(_lines(spark, table_dir))


def _lines(spark: SparkSession, table_dir: str) -> DataFrame:
    return spark.read.schema(LINE_SCHEMA).parquet(table_dir)
