"""Mixing sources to target weights: fixed-length blocks, multinomial shards, index permutations.

The words of a source form one stream, cut into blocks of `block_words`. Each output shard has a
fixed number of slots; a multinomial draw says how many of them go to each source. The k-th slot
of a source, counted over all shards, takes block `permutation(k mod blocks)` of pass
`k div blocks`, a keyed pseudorandom permutation, so a pass takes every block exactly once. Slots
and blocks meet in a join on (source, block).

Draws and permutations depend on the seed and on indices alone: reruns agree, and a lost task is
repeated identically.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a
document without words takes no part and is never taken; repeated rows are separate documents;
an empty table gives an empty mix; columns of other names are ignored. Sources are configuration:
one row per source comes to the driver, and more than `MAX_SOURCES` raise an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.llm.bytes_kernel import mix as scramble
from casemart.llm.common import WORD, bucket_of, partitions, written

MAX_SOURCES = 100_000
WEIGHTS = (3.0, 1.0, 2.0)  # of the sources in order, repeating: fixed values
SHARE, CAP = 1.5, 2.0  # the mix's size over the input's; most passes over a source: fixed values
DOCS_PER_BUCKET = 20_000
SPAN_SHARDS = 4096  # shards whose draws are summed in one task


@dataclass(frozen=True)
class Source:
    index: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def water_fill(
    sizes: Sequence[int], weights: Sequence[float], total: float, floor: float, cap: float
) -> list[float]:
    """Targets level * weight, each held between floor and cap times its size, that sum to total.

    The level is found on the piecewise linear sum of the targets; it is the fixed point of
    resharing, by weight, what a bound leaves over.
    """
    low, high = [floor * s for s in sizes], [cap * s for s in sizes]
    if not sizes or total >= sum(high):
        return high
    turns = sorted(
        [(lo / w, w) for lo, w in zip(low, weights)] + [(hi / w, -w) for hi, w in zip(high, weights)]
    )
    at, filled, slope = 0.0, sum(low), 0.0
    for turn, change in turns:
        step = slope * (turn - at)
        if filled + step >= total and slope > 0:
            break
        at, filled, slope = turn, filled + step, slope + change
    level = at + max(0.0, total - filled) / slope if slope > 0 else at
    return [min(max(level * w, lo), hi) for w, lo, hi in zip(weights, low, high)]


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash of the text) of every row, as a table."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("hash"),
    )
    return written(rows, "mix-sizes")


def plan_sources(sizes: DataFrame, block_words: int, share: float, floor: float, cap: float,
                 weights: Sequence[float] = WEIGHTS) -> list[Source]:
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("size"))
        .orderBy(F.col("source").asc_nulls_last())
        .limit(MAX_SOURCES + 1)
        .collect()
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    amounts = [row["size"] for row in totals]
    own = [weights[i % len(weights)] for i in range(len(totals))]
    targets = water_fill(amounts, own, share * sum(amounts), floor, cap)
    out = []
    for i, (row, target) in enumerate(zip(totals, targets)):
        size, blocks = row["size"], -(-row["size"] // block_words)
        passes = min(int(target // size), int(cap)) if size else 0
        rest = round((target - passes * size) / (size / blocks)) if size else 0
        slots = min(passes * blocks + rest, int(cap * blocks))
        out.append(Source(i, row["source"], size, target, blocks, slots))
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked until back inside the range."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            salt = np.uint64((key * 4 + turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (scramble(right + salt) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def draw_slots(spark, sources: Sequence[Source], shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, source_index, pass, block) of every slot of the mix."""
    quota = np.array([s.slots for s in sources], dtype=np.int64)
    blocks = np.array([s.blocks for s in sources], dtype=np.int64)
    total = int(quota.sum())
    shards = max(1, -(-total // shard_slots))
    schema = "shard long, source_index int, drawn long"

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = quota / max(1, total)
        for batch in batches:
            for shard in batch.column(0).to_numpy():
                size = min(shard_slots, total - int(shard) * shard_slots)
                drawn = np.random.default_rng([seed, int(shard)]).multinomial(size, odds)
                at = np.flatnonzero(drawn)
                yield pa.record_batch(
                    [np.full(len(at), shard), at.astype(np.int32), drawn[at].astype(np.int64)],
                    names=["shard", "source_index", "drawn"],
                )

    drawn = spark.range(shards if total else 0).mapInArrow(draw, schema)
    # Prefix sums over a source's shards: inside spans of shards, and over the spans' totals.
    drawn = drawn.withColumn("span", F.expr(f"shard div {SPAN_SHARDS}"))
    totals = drawn.groupBy("source_index", "span").agg(F.sum("drawn").alias("all"))
    by_source = Window.partitionBy("source_index").orderBy("span")
    before = totals.select(
        "source_index", "span", (F.sum("all").over(by_source) - F.col("all")).alias("before")
    )
    inside = Window.partitionBy("source_index", "span").orderBy("shard")
    limits = F.array(*(F.lit(int(q)) for q in quota)) if total else F.array(F.lit(0))
    upto = (
        drawn.withColumn("upto", F.sum("drawn").over(inside))
        .join(before, ["source_index", "span"])
        .withColumn("quota", limits[F.col("source_index")].cast("long"))
        .withColumn("upto", F.col("before") + F.col("upto"))
    )
    # What a source drew beyond its quota is cut; what it drew too little is dealt over the shards.
    kept = upto.select(
        "shard",
        "source_index",
        F.least("quota", F.col("upto") - F.col("drawn")).alias("first"),
        F.least("quota", F.col("upto")).alias("last"),
    )
    ends = {
        row["source_index"]: min(int(quota[row["source_index"]]), row["all"])
        for row in drawn.groupBy("source_index").agg(F.sum("drawn").alias("all")).collect()
    }
    runs = kept.filter("last > first")
    short = [(i, ends.get(i, 0), int(q)) for i, q in enumerate(quota) if q > ends.get(i, 0)]
    if short:
        runs = runs.unionByName(dealt(spark, short, shards))
    # Runs are a few bytes each and thousands of slots when expanded: spread by number, or they
    # would be merged into few tasks for their size.
    tasks = max(1, min(shards, partitions(spark)))
    runs = runs.select("shard", "source_index", "first", "last").repartition(tasks, "shard")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, source, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                for start in range(first, last, 1 << 16):
                    k = np.arange(start, min(last, start + (1 << 16)), dtype=np.int64)
                    n = int(blocks[source])
                    turn, block = k // n, np.empty(len(k), dtype=np.int64)
                    for t in np.unique(turn):
                        here = turn == t
                        key = (seed * 1_000_003 + source) * 64 + int(t)
                        block[here] = permuted(k[here] % n, n, key)
                    yield pa.record_batch(
                        [
                            np.full(len(k), shard), np.full(len(k), source, dtype=np.int32), k,
                            turn.astype(np.int32), block,
                        ],
                        names=["shard", "source_index", "slot", "pass", "block"],
                    )

    return runs.mapInArrow(
        expand, "shard long, source_index int, slot long, pass int, block long"
    )


def dealt(spark, short: Sequence[tuple[int, int, int]], shards: int) -> DataFrame:
    """The slots (source, first, last) that are missing, as runs over all shards alike."""
    schema = "shard long, source_index int, first long, last long"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            for source, first, last in short:
                each, more = divmod(last - first, shards)
                turn = (shard - source) % shards
                begin = first + turn * each + np.minimum(turn, more)
                end = begin + each + (turn < more)
                at = np.flatnonzero(end > begin)
                yield pa.record_batch(
                    [shard[at], np.full(len(at), source, dtype=np.int32), begin[at], end[at]],
                    names=["shard", "source_index", "first", "last"],
                )

    return spark.range(shards).mapInArrow(deal, schema)


def streams(sizes: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Each document with words, its source's index and its first word's place in the stream.

    The stream is ordered by (bucket, doc_id); prefix sums run inside a bucket and over the
    buckets' totals, so that no task holds a whole source.
    """
    spark = sizes.sparkSession
    names = spark.createDataFrame(
        [(s.index, s.name) for s in sources], "source_index int, source string"
    )
    rows = sizes.filter("size > 0")
    buckets = max(1, rows.count() // DOCS_PER_BUCKET)
    rows = rows.withColumn("bucket", bucket_of(F.col("doc_id"), buckets))
    rows = rows.join(names, rows["source"].eqNullSafe(names["source"])).drop(names["source"])
    totals = rows.groupBy("source_index", "bucket").agg(F.sum("size").alias("words"))
    by_source = Window.partitionBy("source_index").orderBy("bucket")
    before = totals.select(
        "source_index", "bucket", (F.sum("words").over(by_source) - F.col("words")).alias("before")
    )
    inside = (
        Window.partitionBy("source_index", "bucket")
        .orderBy("doc_id", "size", "hash")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = rows.withColumn("upto", F.sum("size").over(inside)).join(
        before, ["source_index", "bucket"]
    )
    return placed.select(
        "doc_id", "source", "source_index", "size", "hash",
        (F.col("before") + F.col("upto") - F.col("size")).alias("at"),
    )


def mix(
    sizes: DataFrame,
    block_words: int = 64,
    shard_slots: int = 1 << 14,
    seed: int = 5,
    share: float = SHARE,
    floor: float = 0.0,
    cap: float = CAP,
) -> tuple[DataFrame, list[Source]]:
    """The mix as pieces of documents, and the planned sources.

    Pieces: shard, slot, pass, source, block, doc_id, at (the document's place in its source's
    stream), start (first word taken of the document) and length in words.
    """
    sources = plan_sources(sizes, block_words, share, floor, cap)
    slots = draw_slots(sizes.sparkSession, sources, shard_slots, seed)
    docs = streams(sizes, sources)
    spans = docs.withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("at") / block_words),
                F.floor((F.col("at") + F.col("size") - 1) / block_words),
            )
        ),
    ).select(
        "doc_id", "source", "source_index", "size", "hash", "at", "block",
        F.greatest(F.lit(0).cast("long"), F.col("block") * block_words - F.col("at")).alias(
            "start"
        ),
        F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("at")).alias("end"),
    )
    # Slots are expanded from a few bytes, so Spark's estimate of them is far too low to broadcast by.
    pieces = slots.hint("merge").join(spans, ["source_index", "block"]).select(
        "shard", "slot", "pass", "source", "source_index", "block", "doc_id", "size", "hash", "at",
        "start", (F.col("end") - F.col("start")).alias("length"),
    )
    return pieces, sources


def mixed_texts(docs: DataFrame, floor: float = 1.0, **options) -> DataFrame:
    """The mix as documents: for each pass that takes of a document, the text of what it takes.

    Rows of `docs` with all columns; a pass that takes the whole document has its text unchanged,
    any other the taken word runs in order, each with the white space after it. With floor 1 every
    document with words occurs whole at least once. n_chars, where there is one, is counted again.
    """
    docs = docs.dropDuplicates(["doc_id", "text"])
    pieces, _ = mix(sized(docs), floor=floor, **options)
    runs = pieces.groupBy("doc_id", "hash", "at", "size", "pass").agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("runs")
    )
    columns = docs.columns
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), *columns
    )
    runs = runs.select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.col("size").alias("_size"),
        F.col("runs").alias("_runs"),
    )
    joined = keyed.join(
        runs, keyed["_id"].eqNullSafe(runs["_id"]) & (keyed["_hash"] == runs["_hash"])
    ).select("text", "_size", "_runs", *(c for c in columns if c != "text"))
    kinds = dict(joined.dtypes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                taken_text(text, size, [(r["start"], r["length"]) for r in runs])
                for text, size, runs in zip(*(batch.column(i).to_pylist() for i in range(3)))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), *batch.columns[3:]],
                names=["text", *(c for c in columns if c != "text")],
            )

    schema = T.StructType(
        [joined.schema["text"], *(joined.schema[c] for c in columns if c != "text")]
    )
    out = joined.mapInArrow(cut, schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))
    return out.select(*columns)


def taken_text(text: str, size: int, runs: list[tuple[int, int]]) -> str:
    if sum(n for _, n in runs) == size:
        return text
    starts = [m.start() for m in re.finditer(WORD, text)] + [len(text)]
    return "".join(text[starts[a] : starts[a + n]] for a, n in runs)


def digest(docs: DataFrame) -> DataFrame:
    """How many words the mix takes of every document, beside its source's size and target."""
    sizes = sized(docs)
    pieces, sources = mix(sizes)
    # A document's place in its source's stream is its own, also where its id is null or shared.
    taken = pieces.groupBy("source_index", "at").agg(F.sum("length").alias("taken"))
    placed = streams(sizes, sources)
    with_words = placed.join(taken, ["source_index", "at"], "left").select(
        "doc_id", "source", "size", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
    rows = with_words.unionByName(
        sizes.filter("size = 0").drop("hash").withColumn("taken", F.lit(0).cast("long"))
    )
    plan = docs.sparkSession.createDataFrame(
        [(s.name, s.size, float(s.target)) for s in sources],
        "source string, source_size long, target double",
    )
    return rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
