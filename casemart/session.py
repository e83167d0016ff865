"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What one reduce task should read of a shuffle, so that sorts and hash tables stay in memory.
TASK_BYTES = 128 << 20
# Delimited text is about eight times as large as the compressed shuffle of its rows.
TEXT_TO_SHUFFLE = 8

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    "spark.sql.files.maxPartitionBytes": "256m",
}

# On a cluster merged partitions should reach the advisory size, or written layers fall apart
# into small files; on one machine using every core matters more.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}


def shuffle_partitions_for(input_bytes: int) -> int:
    """Initial shuffle partitions for so many bytes of text, at least Spark's default of 200.

    AQE merges small partitions but never adds any, so the wide shuffle of the deduplication
    needs enough of them from the start: about 100,000 for 100 TB.
    """
    return max(200, -(-input_bytes // (TASK_BYTES * TEXT_TO_SHUFFLE)))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the shuffle partitions of a running session for an input of this size."""
    n = shuffle_partitions_for(input_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def get_session(
    app: str = "casemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with `SETTINGS`; on a cluster leave `master` unset and let spark-submit decide.

    Give either the number of shuffle partitions or the size of the input to derive it from.
    """
    if input_bytes and not shuffle_partitions:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = dict(SETTINGS) if master else {**SETTINGS, **CLUSTER_SETTINGS}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
