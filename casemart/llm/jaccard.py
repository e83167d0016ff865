"""N-gram Jaccard join: a grouped prefix join over the word shingles of whole texts.

1. Shingle hashes get a global order: first those of a fixed share of the hash range that occur
   in one text only, then the share's others by rising frequency, then the rest. Occurrences in the
   share are counted exactly over all texts; bitmaps of fixed size carry the result (`order_of`).
2. Texts with equal shingle sets are one set with copies; sets of equal size and prefix are one
   group. Two sets that reach the threshold share a token of their prefixes, the first
   size - ceil(t * size) + 1 tokens in the order. Tokens of one text only need no list, and lists
   are kept by token and size range (sets link only within a range or with the next one).
3. Two groups of a list are a pair if the tokens from the listed one on could still reach the
   overlap that their sizes ask for. In the list of their first token in common this holds for all
   groups with a link, so no pair is lost. Long lists are compared in tiles of two blocks of groups;
   a tile gives a spanning forest of its pairs. Groups joined by pairs form a cluster.
4. A cluster's groups are expanded to their sets, which meet in tiles of two blocks of about `BLOCK`
   sets: no task holds a whole cluster, and a set travels once per tile, not once per list. A tile
   filters its group pairs again by the exact overlap of their whole prefixes, verifies the members
   of the remaining pairs by exact intersections, and gives each set's number of links and a
   spanning forest of the links, never all pairs.

Everything counts: no list, candidate or partner is dropped. Links need
`den * |intersection| >= num * |union|` on exact sets of 56-bit hashes.

Defined cases: a null or empty text, or one of white space, has an empty set and no link; a text of
fewer than n words has its whole word sequence as one shingle; copies are linked; repeated rows
count as copies; rows without a doc_id are compared by their text only; an empty table gives an
empty result; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.bytes_kernel import MIX_A, MIX_B, ODD, Shingler, mix, slices, text_batch
from casemart.llm.common import Bitmap, small_batches, tidy, written
from casemart.llm.components import components

SHARE = 1.8  # of the longest prefix: the part of the hash range whose tokens are counted
FREQUENT = {2: 25, 16: 22, 256: 22, 4096: 20}  # occurrences that count as a class: bitmap's bits
BATCH_BYTES = 1 << 19
BLOCK = 256  # sets of one block of a tile
LIST_BLOCK = 1024  # groups of one block of a long list
PAIRS_AT_ONCE = 1 << 20
TOKEN = np.uint64((1 << 56) - 1)


def shingle_sets(batch: pa.RecordBatch, column: int, shingler: Shingler):
    """(first row, sets) of each slice of a batch."""
    data, offsets = text_batch(batch.column(column))
    for lo, hi in slices(offsets, BATCH_BYTES):
        part = data[offsets[lo] : offsets[hi]]
        yield lo, shingler.sets(part, offsets[lo : hi + 1] - offsets[lo])


def order_of(docs: DataFrame, n: int, num: int, den: int) -> Order:
    """Count the tokens of the low share of the hash range over all texts."""
    share = min(1.0, SHARE * (den - num) / den)
    limit = np.uint64(int(share * (1 << 64)) - 1)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for _, sets in shingle_sets(batch, 0, shingler):
                low = np.concatenate([s[: np.searchsorted(s, limit)] for s in sets])
                found, times = np.unique(low, return_counts=True)
                yield pa.record_batch(
                    [pa.array(mix(found).view(np.int64)), pa.array(times, pa.int64())],
                    names=["token", "times"],
                )

    counted = docs.select("text").mapInArrow(count, "token long, times long")
    counted = counted.groupBy("token").agg(F.sum("times").alias("times")).filter("times > 1")
    counted = written(counted, "repeated-tokens")
    maps = [
        Bitmap.of(counted.filter(F.col("times") >= times), "token", bits)
        for times, bits in FREQUENT.items()
    ]
    return Order(n, num, den, limit, maps)


class Order:
    """The global order of shingle hashes, for texts compared by n-grams at num / den."""

    def __init__(self, n: int, num: int, den: int, limit: np.uint64, maps: list[Bitmap]):
        self.n, self.num, self.den, self.limit, self.maps = n, num, den, limit, maps
        # Sizes that can link are at most one range apart.
        self.width = np.log(den / num) * (1 + 1e-9)

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """A set's tokens in the order: class in the top byte, 56 bits of the hash below."""
        kind = np.full(len(hashes), len(FREQUENT) + 1, dtype=np.uint64)
        low = int(np.searchsorted(hashes, self.limit))
        keys = mix(hashes[:low].copy())
        kind[:low] = sum(m.has(keys).astype(np.uint64) for m in self.maps)
        return np.sort(kind << np.uint64(56) | hashes & TOKEN)

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        return tokens[: len(tokens) - -(-self.num * len(tokens) // self.den) + 1]

    def reach(self, overlap, size, other):
        """Whether sets of these sizes with this overlap are similar enough."""
        return (self.num + self.den) * overlap >= self.num * (size + other)

    def size_range(self, sizes):
        return np.floor(np.log(sizes) / self.width).astype(np.int64)

    def lists(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """The lists that a set stands in, and a hash of its size and prefix."""
        size = len(tokens)
        prefix = self.prefix(tokens)
        group = mix(np.uint64(size) + mix(prefix ^ MIX_B)[None].sum(axis=1))[0]
        shared = prefix[prefix >> np.uint64(56) > 0]
        here = int(self.size_range(size))
        lists = np.concatenate([list_keys(shared, here), list_keys(shared, here + 1)])
        return lists, group


def list_keys(tokens: np.ndarray, size_range) -> np.ndarray:
    return mix(tokens + np.asarray(size_range).astype(np.uint64) * ODD)


def prefixes(docs: DataFrame, order: Order) -> DataFrame:
    """(doc_id, text_key, n, d1, d2, gid, lists): set size, 128-bit digest, group and lists of every row."""

    @tidy
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(order.n)
        for batch in batches:
            for lo, sets in shingle_sets(batch, 1, shingler):
                tokens = [order.tokens(s) for s in sets]
                sizes = np.array([len(t) for t in tokens], dtype=np.int64)
                codes = np.zeros((len(tokens), 3), dtype=np.uint64)
                lists = []
                for i, t in enumerate(tokens):
                    codes[i, :2] = mix(t ^ MIX_A).sum(), mix(t ^ MIX_B).sum()
                    keys = np.zeros(0, dtype=np.uint64)
                    if len(t):
                        keys, codes[i, 2] = order.lists(t)
                    lists.append(keys.view(np.int64))
                codes = codes.view(np.int64)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, len(sets)),
                        batch.column(2).slice(lo, len(sets)), pa.array(sizes),
                        pa.array(codes[:, 0]), pa.array(codes[:, 1]), pa.array(codes[:, 2]),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n", "d1", "d2", "gid", "lists"],
                )

    schema = "doc_id long, text_key long, n long, d1 long, d2 long, gid long, lists array<long>"
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(sketch, schema)


def list_entries(groups: DataFrame, num: int, den: int) -> DataFrame:
    """(token, gid, n, rest): the groups in each list, with the tokens from the listed one on.

    A group's lists name its listed tokens, the last ones of its prefix in the order, once for each
    of two size ranges.
    """
    n, half = F.col("n"), F.expr("size(lists) div 2")
    length = n - F.ceil(n * num / F.lit(den)).cast("long") + 1
    entries = groups.select("gid", "n", half.alias("half"), length.alias("length"),
                            F.posexplode("lists").alias("at", "token"))
    place = F.col("length") - F.col("half") + F.col("at") % F.col("half")
    return entries.select("token", "gid", "n", (n - place).alias("rest"))


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of `size` nodes reaches over the edges (a, b)."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def list_pairs(starts: np.ndarray, n: np.ndarray, rest: np.ndarray, order: Order):
    """(rows, roots): a spanning forest of the pairs in the lists that begin at `starts`."""
    ends = np.append(starts[1:], len(n))
    partners = np.repeat(ends, ends - starts) - np.arange(len(n)) - 1  # later rows of the list
    done = np.concatenate([[0], np.cumsum(partners)])
    first = 0
    while first < len(starts):
        lo = starts[first]
        last = int(np.searchsorted(done[ends], done[lo] + PAIRS_AT_ONCE, "right"))
        last = max(last, first + 1)
        hi = ends[last - 1]
        count = partners[lo:hi]
        a = np.repeat(np.arange(hi - lo), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(done[lo:hi] - done[lo], count)
        size, left = n[lo:hi], rest[lo:hi]
        pair = order.reach(np.minimum(left[a], left[b]), size[a], size[b])
        root = forest(hi - lo, a[pair], b[pair])
        rows = np.flatnonzero(root != np.arange(hi - lo))
        yield rows + lo, root[rows] + lo
        first = last


def group_edges(sets: DataFrame, order: Order) -> DataFrame:
    """(gid, hub): pairs of groups that may hold a link, as a forest for each tile of a list."""
    groups = sets.groupBy("gid").agg(F.min("n").alias("n"), F.min("lists").alias("lists"))
    entries = list_entries(groups, order.num, order.den)
    shared = written(
        entries.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"),
        "shared-tokens",
    )
    maybe = Bitmap.of(shared, "token", 24)
    narrow = "token long, gid long, n long, rest long"

    @tidy
    def only_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe.has(batch.column(0).to_numpy())))

    @tidy
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows, starts):
            for at, root in list_pairs(starts, rows[4], rows[5], order):
                yield pa.record_batch(
                    [pa.array(rows[3][at]), pa.array(rows[3][root])], names=["gid", "hub"]
                )

        rows = None
        for batch in batches:
            new = [column.to_numpy() for column in batch.columns]
            rows = new if rows is None else [np.concatenate(c) for c in zip(rows, new)]
            if not len(rows[0]):
                continue
            differs = np.any([c[1:] != c[:-1] for c in rows[:3]], axis=0)
            starts = np.append(0, np.flatnonzero(differs) + 1)
            # The last tile may go on in the next batch.
            yield from found([c[: starts[-1]] for c in rows], starts[:-1])
            rows = [c[starts[-1] :].copy() for c in rows]
        if rows is not None and len(rows[0]):
            yield from found(rows, np.array([0]))

    blocks = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    keys = ["token", "left", "right"]
    block = F.pmod(F.xxhash64("gid"), blocks).cast("int")
    tiles = (
        entries.mapInArrow(only_shared, narrow)
        .join(shared, "token")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("token", F.least("block", "other").alias("left"),
                F.greatest("block", "other").alias("right"), "gid", "n", "rest")
    )
    tiles = tiles.repartition(*keys).sortWithinPartitions(*keys)
    return tiles.mapInArrow(pairs, "gid long, hub long").distinct()


def clusters_of(sets: DataFrame, order: Order) -> DataFrame:
    """(cluster, gid, rep, d1, d2, copies, size) of the sets whose group has a pair or more sets."""
    linked = components(group_edges(sets, order), "gid", "hub")
    placed = (
        sets.join(linked.withColumnRenamed("node", "gid"), "gid", "left")
        .withColumn("cluster", F.coalesce("component", "gid"))
        .select("cluster", "gid", "rep", "d1", "d2", "copies")
    )
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return placed.join(sizes, "cluster")


def overlaps(sets) -> np.ndarray:
    """The size of every two sets' intersection."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    both = np.zeros((m, m), dtype=np.float32)
    tokens, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    use = counts[code] > 1
    code, row = (np.cumsum(counts > 1) - 1)[code[use]], row[use]
    by_code = np.argsort(code, kind="stable")
    code, row = code[by_code], row[by_code]
    width = max(256, (1 << 20) // m)
    last = int(code[-1]) + 1 if len(code) else 0
    for start in range(0, last, width):
        lo, hi = np.searchsorted(code, [start, start + width])
        part = np.zeros((m, min(width, last - start)), dtype=np.float32)
        part[row[lo:hi], code[lo:hi] - start] = 1
        both += part @ part.T  # exact: sums of at most 2**24 ones
    return np.rint(both).astype(np.int64)


def group_pairs(sets, order: Order) -> np.ndarray:
    """Which groups, one set of each given, may hold a link: every group with itself, and others
    whose prefixes share a token and leave enough of both sets behind the shorter prefix' end."""
    sizes = np.array([len(s) for s in sets])
    prefixes = [order.prefix(s) for s in sets]
    ends = np.array([p[-1] for p in prefixes])
    common = overlaps(prefixes)
    passed = np.stack([np.searchsorted(p, ends, "right") for p in prefixes], axis=1)
    left = np.minimum((sizes - np.diagonal(passed))[:, None], sizes - passed)
    left = np.where(ends[:, None] <= ends, left, left.T)
    pairs = (common > 0) & order.reach(common + left, sizes[:, None], sizes)
    np.fill_diagonal(pairs, True)
    return pairs


def compare_tile(sets, groups, blocks, copies, order: Order):
    """Links of one tile: per set the copies it is linked to, and the root of its links' tree.

    Only members of group pairs are verified. Sets of one block are compared where the tile is that
    block with itself, else only sets of different blocks.
    """
    m = len(sets)
    _, member, group = np.unique(groups, return_index=True, return_inverse=True)
    pairs = group_pairs([sets[i] for i in member], order)[group][:, group]
    blocks = np.asarray(blocks)
    if (blocks != blocks[0]).any():
        pairs &= blocks[:, None] != blocks
    np.fill_diagonal(pairs, False)
    links, root = np.zeros(m, dtype=np.int64), np.arange(m)
    at = np.flatnonzero(pairs.any(axis=1))
    if not len(at):
        return links, root
    sizes = np.array([len(sets[i]) for i in at])
    linked = pairs[np.ix_(at, at)]
    linked &= order.reach(overlaps([sets[i] for i in at]), sizes[:, None], sizes)
    links[at] = linked @ np.asarray(copies, dtype=np.int64)[at]
    root[at] = at[forest(len(at), *np.nonzero(linked))]
    return links, root


LINKS = "rep long, d1 long, root long, links long"


def compare(tiles: DataFrame, order: Order) -> DataFrame:
    """Run `compare_tile` over the rows of every tile, which stand together in a partition."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, sets = None, [], []

        def flush():
            if len(rows) < 2:
                return None
            links, root = compare_tile(
                sets, [r["gid"] for r in rows], [r["block"] for r in rows],
                [r["copies"] for r in rows], order,
            )
            at = np.flatnonzero(links + (root != np.arange(len(rows))))
            at = np.union1d(at, root[at])
            return pa.record_batch(
                [
                    pa.array([rows[i]["rep"] for i in at], pa.int64()),
                    pa.array([rows[i]["d1"] for i in at], pa.int64()),
                    pa.array([rows[root[i]]["rep"] for i in at], pa.int64()),
                    pa.array(links[at], pa.int64()),
                ],
                names=["rep", "d1", "root", "links"],
            )

        for batch in batches:
            # The sets are copied one by one: a tile outlives its batches, a batch holds many tiles.
            tokens = batch.column("tokens")
            for i, row in enumerate(batch.drop_columns(["tokens"]).to_pylist()):
                new = (row["cluster"], row["left"], row["right"])
                if new != key:
                    if (out := flush()) is not None:
                        yield out
                    key, rows, sets = new, [], []
                rows.append(row)
                sets.append(np.frombuffer(tokens[i].as_buffer(), dtype=np.uint64).copy())
        if (out := flush()) is not None:
            yield out

    keys = ["cluster", "left", "right"]
    return tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, LINKS)


def join(
    docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, with_text_key: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row; see the module.

    component_id is the smallest doc_id that links reach, the row's own included; n_links counts
    the rows linked to a row. `with_text_key` adds text_key, xxhash64 of the row's text, which tells
    rows that share a doc_id apart.
    """
    with small_batches(docs.sparkSession):
        out = _join(docs, n, num, den)
    return out if with_text_key else out.drop("text_key")


def _join(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = order_of(docs, n, num, den)
    base = written(prefixes(docs, order), "prefixes")
    # Equal sets have equal groups and lists, so the smallest row of each stands for all.
    sets = written(
        base.filter("n > 0")
        .groupBy("n", "d1", "d2", "gid")
        .agg(F.min("lists").alias("lists"), F.count(F.lit(1)).alias("copies"),
             F.min("doc_id").alias("rep")),
        "sets",
    )
    known = sets.filter("rep is not null")
    clusters = written(clusters_of(known, order), "candidates")

    rep_docs = docs.withColumn("key", F.xxhash64("doc_id"))
    by_id = Bitmap.of(clusters.select(F.xxhash64("rep").alias("key")), "key", 24)

    @tidy
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            batch = batch.filter(pa.array(by_id.has(batch.column(2).to_numpy())))
            for lo, found in shingle_sets(batch, 1, shingler):
                tokens = [order.tokens(s) for s in found]
                d1 = np.array([mix(t ^ MIX_A).sum() for t in tokens], dtype=np.uint64)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, len(found)),
                        pa.array(d1.view(np.int64)),
                        pa.array([t.tobytes() for t in tokens], pa.binary()),
                    ],
                    names=["rep", "d1", "tokens"],
                )

    texts = rep_docs.select("doc_id", "text", "key").mapInArrow(
        fetch, "rep long, d1 long, tokens binary"
    ).dropDuplicates(["rep", "d1"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("rep", "d1"), blocks).cast("int")
    tiles = (
        clusters.join(texts, ["rep", "d1"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "cluster", F.least("block", "other").alias("left"),
            F.greatest("block", "other").alias("right"), "block", "gid", "rep", "d1", "copies",
            "tokens",
        )
    )
    links = written(compare(tiles, order), "links")
    reached = components(links.filter("rep <> root"), "rep", "root")
    counts = links.groupBy("rep", "d1").agg(F.sum("links").alias("links"))
    classed = (
        sets.select("n", "d1", "d2", "rep", "copies")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts, ["rep", "d1"], "left")
        .select(
            "n", "d1", "d2",
            F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    members = base.select("doc_id", "text_key", "n", "d1", "d2").join(classed, ["n", "d1", "d2"], "left")
    return members.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """Four-word shingles and a similarity of 0.85."""
    return join(docs, 4, 85, 100)
