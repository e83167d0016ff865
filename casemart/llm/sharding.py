"""Random shards of a corpus: a two-pass external shuffle.

Built-in functions only. Pass one scatters the records over memory-sized buckets by a seeded hash
of their place in the input files. Pass two shuffles every bucket (Fisher-Yates, Spark's
`shuffle` over the numbers of its rows) and writes it at its offset in the whole order, which is cut
into shards of equal row counts. One shuffle moves the records; counts and permutations
are small tables on the side. A permutation is written before it is used, so a task that is
repeated after a lost executor puts every record at the same place again.

The law is `rows`: row counts of any two shards differ by one at most, whatever the texts, ids or
copies are; a record's bucket depends on nothing in the record, so neither a hot id nor a large
group of equal texts gathers anywhere.

Defined cases: a null or empty text has size 8 and checksum 0; null and repeated doc_ids and
repeated rows are records of their own; all columns, whatever their names, are kept in the struct
`record`; fewer records than shards leave some shards empty; an empty table gives empty shards.
Runs over the same files with the same settings agree.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemart.llm.common import partitions, written
from casemart.sources import shared_dir

SHARDS = 24
SEED = 20_240_607
ROW_BYTES = 8  # counted for a record beside its text; so a bucket's row count is bounded too
BUCKET_BYTES = 64 << 20
OFFSET_ROWS = 4096  # buckets whose counts are summed up in one task


def record_of(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns))


def identified(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(record, mark): `mark` hashes file and row number, so it differs between equal rows.

    A frame that is no plain scan of files is written first and marked by those files.
    """
    mark = F.xxhash64(F.lit(seed), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    one = docs.select(record_of(docs).alias("record"))
    if "_metadata" not in docs.columns:
        try:
            return docs.select(record_of(docs).alias("record"), mark.alias("mark"))
        except AnalysisException:
            pass  # rows of a join, an aggregation or of memory have no file
    return written(one, "sharding-records").select("record", mark.alias("mark"))


def record_size(text: str = "record.text") -> Column:
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + ROW_BYTES


def with_offsets(counts: DataFrame) -> DataFrame:
    """(bucket, rows, offset): the rows in all smaller buckets, summed in two levels."""
    chunk = F.floor(F.col("bucket") / OFFSET_ROWS)
    inside = Window.partitionBy("chunk").orderBy("bucket")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunked = counts.withColumn("chunk", chunk)
    starts = chunked.groupBy("chunk").agg(F.sum("rows").alias("total")).select(
        "chunk", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start")
    )
    sums = chunked.withColumn("upto", F.sum("rows").over(inside))
    return sums.join(starts, "chunk").select(
        "bucket", "rows", (F.col("start") + F.col("upto") - F.col("rows")).alias("offset")
    )


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write `path`/shard=0 ... and return (record, slot, shard); `slot` is gapless from 0."""
    spark = docs.sparkSession
    rows = identified(docs, seed)
    total = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(record_size()).alias("bytes")
    ).first()
    wide = partitions(spark)
    buckets = max(wide, -(-(total["bytes"] or 0) // bucket_bytes))
    bucket = F.pmod(F.col("mark"), F.lit(buckets)).alias("bucket")
    counts = rows.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    # Sorted in a fixed number of partitions, so the seeded generator meets the buckets in the
    # same order in every run.
    orders = written(
        with_offsets(counts)
        .repartition(wide, "bucket")
        .sortWithinPartitions("bucket")
        .select("bucket", "offset", F.shuffle(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1), seed).alias("order")),
        "sharding-orders",
    )
    numbered = rows.select("record", "mark", bucket).select(
        "record",
        "bucket",
        (F.row_number().over(Window.partitionBy("bucket").orderBy("mark")) - 1).alias("number"),
    )
    at = F.col("offset") + F.get("order", F.col("number"))
    placed = numbered.join(orders, "bucket").select("record", at.alias("at"))
    cut = F.expr(f"at * {shards} div {max(1, total['rows'])}")
    # The first place of a shard is the smallest one that the cut gives to it.
    first = F.expr(f"(shard * {total['rows']} + {shards - 1}) div {shards}")
    placed = placed.select("record", "at", cut.alias("shard")).select(
        "record", (F.col("at") - first).alias("slot"), F.col("shard").cast("int").alias("shard")
    )
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return read_shards(spark, path, placed.schema)


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    """Where every document of the written shards lies, read back from them."""
    spark = docs.sparkSession
    root = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}"
    out = write_shards(docs, f"{root}/shards-{uuid.uuid4().hex}")
    return out.select(
        F.col("record.doc_id").alias("doc_id"),
        record_size().alias("size"),
        F.crc32(F.coalesce(F.col("record.text"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
