"""Document fingerprints: 64-bit SimHash, and all fingerprints within a Hamming radius.

Built-in functions only. Every word of a text votes on 64 signed bits with the bits of its hash;
its weight is its length less two (1 to 8), so the long, rare words outvote the short, common ones.
Votes are counted in sums: four 16-bit counters share a signed long, and `CHUNK` words at most go into
one partial sum. Its counters stay below 2**15, so the highest one never reaches the sign and no
sum overflows; a long text is many small groups.

Defined cases: a null or empty text, or one of white space, has the fingerprint 0; equal texts have
equal fingerprints, whatever else their rows hold; repeated rows are fingerprinted once per row;
columns of other names are ignored; empty tables give empty results.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import SPACE, partitions, written

LANES = 0x0001000100010001  # one bit of each of four 16-bit counters
WEIGHT_MAX = 8
CHUNK = 4095  # words of weight 8 that a counter of 15 bits holds: 32,760 votes
BLOCKS, SHARED = 5, 2  # blocks of the permuted tables; blocks that a pair must share


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The keys and the fingerprint (a long) of every row; rows with equal keys count as one."""
    words = texts.select(
        *keys,
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), SPACE)).alias("_at", "_word"),
    )
    votes = words.select(
        *keys,
        F.floor(F.col("_at") / CHUNK).alias("_chunk"),
        F.xxhash64("_word").alias("_hash"),
        F.when(F.col("_word") == "", 0)
        .otherwise(F.least(F.lit(WEIGHT_MAX), F.greatest(F.lit(1), F.length("_word") - 2)))
        .cast("long")
        .alias("_weight"),
    )
    # SQL text for the many like expressions: one call each, where columns would take hundreds.
    packed = votes.groupBy(*keys, "_chunk").agg(
        F.sum("_weight").alias("_total"),
        *(
            F.expr(f"sum((shiftrightunsigned(_hash, {k}) & {LANES}L) * _weight) as _s{k}")
            for k in range(16)
        ),
    )
    counted = packed.groupBy(*keys).agg(
        F.sum("_total").alias("_total"),
        *(
            F.expr(
                f"sum(shiftrightunsigned(_s{k}, {16 * lane}) & 65535L) as _b{16 * lane + k}"
            )
            for k in range(16)
            for lane in range(4)
        ),
    )
    bits = (f"if(2 * _b{i} > _total, shiftleft(1L, {i}), 0L)" for i in range(64))
    return counted.select(*keys, F.expr(" | ".join(bits)).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs of *different* fingerprints at most `radius` bits apart: (query, found, distance).

    Both frames have a column `fingerprint`; equal fingerprints are one row here. Of `BLOCKS`
    blocks, `radius` differing bits leave at least BLOCKS - radius untouched, so a pair meets in
    the table of some choice of `SHARED` blocks; it is kept only in the first such table.
    """
    if BLOCKS - radius < SHARED:
        raise ValueError(f"radius {radius} is too large for {BLOCKS} blocks")
    width = -(-64 // BLOCKS)
    masks = [
        ((1 << min(width, 64 - i * width)) - 1) << (i * width) for i in range(BLOCKS)
    ]
    choices = list(combinations(range(BLOCKS), SHARED))

    def long(mask: int) -> Column:
        return F.lit(mask - (1 << 64) if mask >> 63 else mask)

    def tabled(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(
            *(
                F.struct(
                    F.lit(n).alias("table"),
                    F.col("fingerprint").bitwiseAND(long(sum(masks[i] for i in c))).alias("block"),
                )
                for n, c in enumerate(choices)
            )
        )
        rows = df.select("fingerprint").distinct().select(
            F.col("fingerprint").alias(name), F.explode(keys).alias("k")
        )
        return rows.select(name, "k.table", "k.block")

    pairs = tabled(queries, "query").join(tabled(corpus, "found"), ["table", "block"])
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(
        *(
            F.when(apart.bitwiseAND(long(sum(masks[i] for i in c))) == 0, F.lit(n))
            for n, c in enumerate(choices)
        )
    )
    return pairs.select(
        "query", "found", F.bit_count(apart).alias("distance"), (F.col("table") == first).alias("f")
    ).filter(f"f and distance between 1 and {radius}").drop("f")


def with_next_text(docs: DataFrame, block_rows: int = 4096) -> DataFrame:
    """Each document with the place and text of the next one in descending doc_id (cyclic).

    The order is cut into blocks at quantiles of doc_id. Inside a block a window finds the next
    row; only the first row of every block has to cross, in a table of one row per block.

    (block, place) is the row's identity, place its number in the block. Rows that tie in the order
    are equal, so the same rows come back when they are computed again.
    """
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    n = rows.count()
    blocks = max(1, min(partitions(docs.sparkSession) * 4, -(-n // block_rows)))
    cuts = rows.agg(
        F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)] or [0.5], 10000)
    ).first()[0]
    bounds = F.array(*(F.lit(c) for c in sorted(set(cuts or []))))
    block = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))), F.lit(-1))
    rows = rows.withColumn("block", block)
    order = [F.col("doc_id").desc_nulls_last(), F.sha2("text", 256)]
    inside = Window.partitionBy("block").orderBy(*order)
    linked = rows.select(
        "doc_id", "text", "block",
        F.row_number().over(inside).alias("place"),
        F.lead("text").over(inside).alias("next_text"),
        F.lead(F.lit(True)).over(inside).alias("has_next"),
    )
    # One row per block: its first document, which follows the last one of the block before.
    firsts = rows.groupBy("block").agg(
        F.min_by(
            "text", F.struct(F.col("doc_id").isNull(), -F.coalesce("doc_id", F.lit(0)), F.sha2("text", 256))
        ).alias("text")
    )
    across = Window.orderBy(F.col("block").desc())
    after = F.struct("block", "text")
    ring = firsts.select(
        "block",
        F.coalesce(F.lead(after).over(across), F.first(after).over(across)).alias("head"),
    )
    has_next = F.col("has_next").isNotNull()
    return linked.join(ring, "block").select(
        "block",
        "place",
        "doc_id",
        "text",
        F.when(has_next, F.col("block")).otherwise(F.col("head.block")).alias("next_block"),
        F.when(has_next, F.col("place") + 1).otherwise(1).alias("next_place"),
        F.when(has_next, F.col("next_text")).otherwise(F.col("head.text")).alias("next_text"),
    )


def digest(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and near neighbours.

    n_near, for every document whose id is divisible by 20: how many other rows of the table have
    a fingerprint at most `radius` bits from its own; null for the rest.
    """
    linked = with_next_text(docs.select(F.col("doc_id").cast("long"), "text"))
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), chars - half), F.substr("next_text", F.lit(1), half)
    )
    # (block, place) keeps equal rows apart, in the result and in the counters.
    keys = ["block", "place", "doc_id", "next_block", "next_place", "n_chars", "edited_sha256"]
    sides = (
        linked.select(*keys[:5], chars.cast("long").alias("n_chars"), "text",
                      edited.alias("edited"))
        .withColumn("edited_sha256", F.sha2("edited", 256))
        .select(*keys, F.posexplode(F.array("text", "edited")).alias("side", "text"))
    )
    prints = written(
        fingerprints(sides, [*keys, "side"])
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("own"),
            F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited"),
        ),
        "simhash",
    )
    following = prints.select(
        F.col("block").alias("next_block"), F.col("place").alias("next_place"),
        F.col("own").alias("next_own"),
    )
    counts = prints.groupBy(F.col("own").alias("found")).agg(F.count(F.lit(1)).alias("rows"))
    corpus = counts.select(F.col("found").alias("fingerprint"))
    asked = prints.filter("doc_id % 20 = 0").select(F.col("own").alias("fingerprint")).distinct()
    near = (
        within_radius(asked, corpus, radius)
        .select("query", "found")
        .unionByName(asked.select(F.col("fingerprint").alias("query"),
                                  F.col("fingerprint").alias("found")))
        .join(counts, "found")
        .groupBy(F.col("query").alias("own"))
        .agg((F.sum("rows") - 1).alias("n_near"))
    )
    text_hex = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return (
        prints.join(following, ["next_block", "next_place"])
        .join(near, "own", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            text_hex(F.col("own")).alias("fingerprint"),
            text_hex(F.col("edited")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("edited")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
            F.when(F.col("doc_id") % 20 == 0, F.col("n_near")).alias("n_near"),
        )
    )
