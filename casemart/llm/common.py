"""Helpers shared by the operators: input tables, written intermediate tables, bounded filters."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.sources import shared_dir, write_and_read

# White space between words: fixed values.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table below the shared folder: cuts the lineage, survives a lost executor.

    The tables lie in `<shared folder>/llm/<application id>` and may go when the application ends.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}"
    return write_and_read(df, f"{root}/{label}-{uuid.uuid4().hex}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: Column, buckets: int | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets) if isinstance(buckets, int) else buckets)


class Bitmap:
    """A set of 64-bit keys in a fixed number of bits: never misses a member, may add others.

    Its size does not depend on the data (2**log_bits bits), so it may be sent to every task; where
    the keys outgrow it, it only lets more rows through, which later steps sort out exactly.
    """

    CHUNK = 1 << 16  # bits kept in one row while the bitmap is collected

    def __init__(self, bits: np.ndarray, log_bits: int):
        self.bits, self.log_bits = bits, log_bits

    @classmethod
    def of(cls, keys: DataFrame, column: str, log_bits: int = 25) -> Bitmap:
        slot = F.shiftrightunsigned(F.col(column), 64 - log_bits)
        slots = keys.select(slot.alias("slot")).distinct()
        chunk = cls.CHUNK

        def pack(part: pa.Table) -> pa.Table:
            at = part["slot"].to_numpy()
            bits = np.zeros(chunk, dtype=np.uint8)
            bits[at % chunk] = 1
            return pa.table({"chunk": [int(at[0] // chunk)], "bits": [np.packbits(bits).tobytes()]})

        packed = (
            slots.withColumn("chunk", (F.col("slot") / chunk).cast("long"))
            .groupBy("chunk")
            .applyInArrow(pack, "chunk long, bits binary")
        )
        out = np.zeros((1 << log_bits) // 8, dtype=np.uint8)
        for row in packed.collect():  # at most 2**log_bits / CHUNK rows, 2**log_bits / 8 bytes
            start = row.chunk * chunk // 8
            out[start : start + chunk // 8] = np.frombuffer(row.bits, dtype=np.uint8)
        return cls(out, log_bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(np.uint64) >> np.uint64(64 - self.log_bits)
        byte = self.bits[(slot >> np.uint64(3)).astype(np.int64)]
        return (byte >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1 == 1


BATCH_MEMORY = 8 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Batches of a few megabytes between Spark and the tasks, for whatever runs inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_MEMORY))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def tidy(run: Callable) -> Callable:
    """`run` over a task's batches; what the task has freed goes back to the machine at its end.

    Workers live on after a task, and beside the next stage their free memory is still theirs.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library keeps its own counsel

    return whole


def arrow_map(df: DataFrame, function, schema: str, columns: Sequence[str]) -> DataFrame:
    """`function(batch) -> iterable of batches` over the named columns of every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.select(*columns).mapInArrow(run, schema)
