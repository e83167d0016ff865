"""Suffix-array dedup: remove every byte of a string of `length` bytes that started earlier.

The collection's suffixes are sorted column by column: each round inserts one symbol per string
in front of its suffix and updates, by one stable sort, the order of all suffixes (whose preceding
symbols are the collection's Burrows-Wheeler transform) and the common prefixes of neighbours
(`column_repeats`). Neighbours with a common prefix of `length` are the repeated strings.

A round for each byte of the longest text over all texts would be a job per byte, so the strings
are first cut where repeats cannot cross, and aligned where repeats must meet:

1. Every window of `length` bytes has an anchor, its smallest-hashed gram. Equal windows have equal
   anchors at equal offsets. Windows with the same anchor make one fragment (about 30 windows).
2. Only anchors that occur twice can matter; they are counted over all texts, and a bitmap of fixed
   size passes them (and a few others) on.
3. Of equal fragments the earliest stays, all others go as a whole: pre-aggregated per slice of
   text before the shuffle.
4. Distinct fragments with the same anchor are the strings of the collection, aligned at the
   anchor. Columns run from the right end to the left, in tasks that hold whole anchors. Suffixes
   of one column are all that a round has to compare, so older columns need not be kept.
5. An anchor with more than `split_fragments` distinct fragments would overfill a task. Its
   fragments are cut into half as many columns each; the windows of such a piece share more symbols
   than the anchor, and pieces that share them are a group of their own. Of equal pieces the
   earliest stays; groups still too large are cut again, down to single columns, where all pieces of
   a group are equal. All groups end in the same column-wise construction.

Defined cases: a null text is empty; texts shorter than `length` keep everything; rows that share a
doc_id are separate documents, ordered by a hash of their text, and exactly equal rows are one
document; rows without a doc_id come last; an empty table gives an empty result; columns of other
names are ignored. Strings are judged on the input, overlapping matches all count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.llm.bytes_kernel import (
    MIX_A,
    MIX_B,
    ODD,
    Powers,
    byte_codes,
    mix,
    ragged,
    slices,
    text_batch,
)
from casemart.llm.common import Bitmap, arrow_map, written

LENGTH = 100  # bytes of a string that counts as repeated: fixed value
GRAM = 40  # bytes of an anchor
BATCH_BYTES = 1 << 19
SPLIT_FRAGMENTS = 4_000  # strings of a group that are sorted in one task
SEEN_BITS = 18
SYMBOLS = 1 << 22  # bytes of fragments sorted together in a task
LAST = (1 << 63) - 1  # stands for a null doc_id


class Anchors:
    """Fragments of many texts: for each, its anchor's hash, its place and its own digest."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.codes = byte_codes(11)
        self.powers = Powers()

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """text (row), lo (first window, in the batch), windows, back (anchor - lo), key, digest."""
        length, gram = self.length, self.gram
        n, width = len(data), length - gram + 1
        windows = n - length + 1
        if windows < 1:
            none = np.zeros(0, dtype=np.int64)
            empty = none.astype(np.uint64)
            return {"text": none, "lo": none, "windows": none, "back": none, "key": empty,
                    "digest": empty}
        up, down = self.powers.to(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.codes[data] * up[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        at = self._smallest(grams, width, windows)
        # A window belongs to a text if it starts and ends in it.
        text = np.zeros(n + 1, dtype=np.int32)
        starts, many = np.unique(offsets[1:-1], return_counts=True)
        text[starts] = many
        text = np.cumsum(text[:n], dtype=np.int32)
        new = np.ones(windows, dtype=bool)
        np.not_equal(at[1:], at[:-1], out=new[1:])
        inside = text[:windows] == text[length - 1 :]
        new[1:] |= inside[1:] != inside[:-1]
        new[1:] |= text[1:windows] != text[: windows - 1]
        lo = np.flatnonzero(new)
        count = np.diff(np.append(lo, windows))
        keep = inside[lo]
        lo, count = lo[keep], count[keep]
        back = at[lo] - lo
        digest = mix((sums[lo + count - 1 + length] - sums[lo]) * down[lo])
        digest = mix(digest + back.astype(np.uint64) * ODD + count.astype(np.uint64) * MIX_A)
        return {"text": text[lo].astype(np.int64), "lo": lo, "windows": count, "back": back,
                # Smallest hashes crowd at the low end: scrambled again, keys fill all 64 bits.
                "key": mix(grams[at[lo]] + ODD), "digest": digest}

    @staticmethod
    def _smallest(grams: np.ndarray, width: int, windows: int) -> np.ndarray:
        """Position of the first smallest hash among grams p .. p + width - 1, for every p.

        Running minima of blocks of `width`, forward and backward: two of them cover any window.
        """
        bits = np.uint64(max(1, (width - 1).bit_length()))
        blocks = -(-len(grams) // width) + 1
        packed = np.full(blocks * width, np.uint64(2**64 - 1))
        packed[: len(grams)] = grams
        packed = packed.reshape(blocks, width) >> bits << bits
        packed |= np.arange(width, dtype=np.uint64)
        ahead = np.minimum.accumulate(packed, axis=1).ravel()
        behind = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].ravel()
        left, right = behind[:windows], ahead[width - 1 : windows + width - 1]
        place = np.arange(windows, dtype=np.int64)
        first = (left >> bits) <= (right >> bits)
        base = np.where(first, place, place + width - 1) // width * width
        low = (np.uint64(1) << bits) - np.uint64(1)
        return base + (np.where(first, left, right) & low).astype(np.int64)


def column_repeats(
    data: np.ndarray, offsets: np.ndarray, back: np.ndarray, group: np.ndarray, rank: np.ndarray,
    length: int = LENGTH,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the strings that are not the first of their kind: (string, first, count) runs.

    Strings of a group (contiguous, ascending) are aligned at their anchors, `back` symbols after
    their starts. A round handles one column, from the right: every string that has a symbol there
    puts it in front of its suffix. `order` holds the strings by group and suffix, `common` the
    common prefix of each with the one before. Where neighbours share `length` symbols, all but the
    one of the lowest rank have a repeated window in this column.
    """
    sizes = np.diff(offsets)
    windows = sizes - length + 1
    shown = np.cumsum(np.append(0, windows))
    repeated = np.zeros(shown[-1], dtype=bool)
    entry = sizes - back - 1  # column of the last symbol
    leave = -back  # column of the first symbol
    entering = np.argsort(-entry, kind="stable")
    upcoming = 0
    order = np.zeros(0, dtype=np.int64)
    common = np.zeros(0, dtype=np.int64)
    group = group.astype(np.int64)
    exits = np.sort(-leave)  # a string leaves after column `leave`
    gone = 0
    for column in range(int(entry.max()), int(leave.min()) - 1, -1):
        last = np.searchsorted(exits, -column, side="left")
        if last > gone:  # strings that started right of this column
            gone = last
            stay = np.flatnonzero(leave[order] <= column)
            if len(stay):
                cuts = np.append(0, stay[:-1] + 1)
                common = np.minimum.reduceat(common[: stay[-1] + 1], cuts)
            else:
                common = common[:0]
            order = order[stay]
        stop = upcoming
        while stop < len(entering) and entry[entering[stop]] == column:
            stop += 1
        if stop > upcoming:  # empty suffixes come first in their groups
            new = np.sort(entering[upcoming:stop])
            upcoming = stop
            order = np.concatenate([new, order])
            common = np.concatenate([np.zeros(len(new), dtype=np.int64), common])
            sort = np.argsort(group[order], kind="stable")
            order, common = order[sort], common[sort]
        if not len(order):
            continue
        symbol = data[offsets[order] + back[order] + column]
        key = group[order] * 256 + symbol
        sort = np.argsort(key, kind="stable")
        common = _next_common(common, key, sort, length)
        order = order[sort]
        same = common >= length
        if same.any():
            # Runs of equal windows: an entry and all after it that share `length` symbols.
            member = same.copy()
            member[:-1] |= same[1:]
            at = np.flatnonzero(member)
            heads = np.flatnonzero(~same[at])
            first = np.minimum.reduceat(rank[order[at]], heads)
            first = np.repeat(first, np.diff(np.append(heads, len(at))))
            later = order[at][rank[order[at]] != first]
            repeated[shown[later] + column + back[later]] = True
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run may cross from one string into the next: cut it at the strings' borders.
    cut = np.union1d(starts, shown[:-1][repeated[shown[:-1]]]) if len(repeated) else starts
    stops = np.union1d(ends, shown[1:][repeated[shown[1:] - 1]]) if len(repeated) else ends
    owner = np.searchsorted(shown, cut, side="right") - 1
    return owner, cut - shown[owner], stops - cut


def _next_common(common: np.ndarray, key: np.ndarray, sort: np.ndarray, length: int) -> np.ndarray:
    """Common prefixes after one more symbol: one more than the least between both old places."""
    out = np.zeros(len(sort), dtype=np.int64)
    same = np.append(False, key[sort][1:] == key[sort][:-1])
    near = same & np.append(False, sort[1:] == sort[:-1] + 1)
    out[near] = common[sort[near]] + 1
    far = np.flatnonzero(same & ~near)
    if len(far):
        pairs = np.empty(2 * len(far), dtype=np.int64)
        pairs[0::2], pairs[1::2] = sort[far - 1] + 1, sort[far] + 1
        padded = np.append(common, 0)
        out[far] = np.minimum.reduceat(padded, pairs)[0::2] + 1
    return np.minimum(out, length)


def row_ids(docs: DataFrame) -> DataFrame:
    """(doc, key, hash, text): doc_id or `LAST`, hash of doc, hash of the text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        doc.alias("doc"), F.xxhash64(doc).alias("key"), F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )


def texts_of(batch: pa.RecordBatch, several: Bitmap):
    """(doc, version, data, offsets) of each slice of rows; version tells equal doc_ids apart."""
    doc, key, code = (batch.column(i).to_numpy() for i in range(3))
    version = np.where(several.has(key), code, 0)
    data, offsets = text_batch(batch.column(3))
    for lo, hi in slices(offsets, BATCH_BYTES):
        part = data[offsets[lo] : offsets[hi]]
        yield doc[lo:hi], version[lo:hi], part, offsets[lo : hi + 1] - offsets[lo]


COLUMNS = ["doc", "key", "hash", "text"]
FOUND = "doc long, version long, lo int, windows int, back int, anchor long, digest long"


def repeated_anchors(rows: DataFrame, length: int, gram: int) -> Bitmap:
    """The anchors that occur at least twice in all texts, as a bitmap."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            data, offsets = text_batch(batch.column(0))
            for lo, hi in slices(offsets, BATCH_BYTES):
                part = data[offsets[lo] : offsets[hi]]
                found = finder.fragments(part, offsets[lo : hi + 1] - offsets[lo])
                keys, times = np.unique(found["key"], return_counts=True)
                yield pa.record_batch(
                    [pa.array(keys.view(np.int64)), pa.array(np.minimum(times, 2).astype(np.int8))],
                    names=["anchor", "times"],
                )

    counted = rows.select("text").mapInArrow(count, "anchor long, times byte")
    twice = counted.groupBy("anchor").agg(F.sum("times").alias("times")).filter("times > 1")
    return Bitmap.of(twice, "anchor", 25)


class Seen:
    """Places of fragments that a task has met: as many as a table of fixed size holds.

    A fragment with an earlier equal in the table is a repeat for certain, so a passage that occurs
    everywhere sends a few fragments per task to be compared, not one per slice of text.
    """

    def __init__(self, bits: int = SEEN_BITS):
        self.shift = np.uint64(64 - bits)
        self.key = np.zeros(1 << bits, dtype=np.uint64)
        self.digest = np.zeros(1 << bits, dtype=np.uint64)
        self.place = np.full((3, 1 << bits), LAST, dtype=np.int64)

    def later(self, key, digest, *place) -> np.ndarray:
        """Which fragments have an earlier equal; the others are remembered."""
        slot = (mix(key * ODD + digest) >> self.shift).astype(np.int64)
        known = (self.key[slot] == key) & (self.digest[slot] == digest)
        less, tied = np.zeros(len(slot), dtype=bool), known
        for column, mine in zip(self.place, place):
            less |= tied & (column[slot] < mine)
            tied = tied & (column[slot] == mine)
        new = np.flatnonzero(~less)
        # One fragment for each slot, whichever it is.
        slots, at = np.unique(slot[new], return_index=True)
        chosen = new[at]
        self.key[slots], self.digest[slots] = key[chosen], digest[chosen]
        for column, mine in zip(self.place, place):
            column[slots] = mine[chosen]
        return less


def candidate_fragments(rows, several, anchors, length, gram) -> DataFrame:
    """Fragments with a repeated anchor. Those known to have an earlier equal in the task's texts
    have anchor null and a digest of their own: they are repeats already."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen = Anchors(length, gram), Seen()
        for batch in batches:
            for doc, version, data, offsets in texts_of(batch, several):
                found = finder.fragments(data, offsets)
                use = anchors.has(found["key"])
                found = {k: v[use] for k, v in found.items()}
                text = found["text"]
                doc, version = doc[text], version[text]
                place = found["lo"] - offsets[text]
                key, digest = found["key"], found["digest"]
                order = np.lexsort((place, version, doc, digest, key))
                again = np.append(
                    False, (key[order][1:] == key[order][:-1])
                    & (digest[order][1:] == digest[order][:-1]),
                )
                later = np.zeros(len(order), dtype=bool)
                later[order] = again
                # Equal rows of the table give the same fragment twice: that is not a repeat.
                same = np.append(
                    False,
                    (doc[order][1:] == doc[order][:-1])
                    & (version[order][1:] == version[order][:-1])
                    & (place[order][1:] == place[order][:-1]),
                )
                drop = np.zeros(len(order), dtype=bool)
                drop[order] = again & same
                head = np.flatnonzero(~later & ~drop)
                later[head] = seen.later(
                    key[head], digest[head], doc[head], version[head], place[head]
                )
                own = mix(doc.view(np.uint64) * ODD + place.astype(np.uint64) + key)
                keep = ~drop
                yield pa.record_batch(
                    [
                        pa.array(doc[keep]), pa.array(version[keep]),
                        pa.array(place[keep].astype(np.int32)),
                        pa.array(found["windows"][keep].astype(np.int32)),
                        pa.array(found["back"][keep].astype(np.int32)),
                        pa.array(key[keep].view(np.int64), mask=later[keep]),
                        pa.array(np.where(later, own, digest)[keep].view(np.int64)),
                    ],
                    names=["doc", "version", "lo", "windows", "back", "anchor", "digest"],
                )

    return rows.select(*COLUMNS).mapInArrow(find, FOUND)


def place_keys(doc: np.ndarray, lo: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """A hash of a fragment's place and content."""
    value = doc.view(np.uint64) * MIX_B + lo.astype(np.int64).view(np.uint64) * ODD
    return mix(value + digest.view(np.uint64))


def fragment_bytes(rows, several, strings, length, gram) -> DataFrame:
    """(doc, version, lo, digest, bytes) of the fragments in `strings`, and maybe a few others."""

    def hashed(batch: pa.RecordBatch):
        doc, lo, digest = (batch.column(i).to_numpy() for i in range(3))
        yield pa.record_batch(
            [pa.array(place_keys(doc, lo, digest).view(np.int64))], names=["key"]
        )

    keys = arrow_map(strings, hashed, "key long", ["doc", "lo", "digest"])
    wanted = Bitmap.of(keys, "key", 25)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            for doc, version, data, offsets in texts_of(batch, several):
                found = finder.fragments(data, offsets)
                text, lo, digest = found["text"], found["lo"], found["digest"]
                place = lo - offsets[text]
                use = np.flatnonzero(wanted.has(place_keys(doc[text], place, digest)))
                size = found["windows"][use] + length - 1
                ends = np.cumsum(np.append(0, size)).astype(np.int64)
                joined = data[ragged(lo[use], size)]
                yield pa.record_batch(
                    [
                        pa.array(doc[text[use]]), pa.array(version[text[use]]),
                        pa.array(place[use].astype(np.int32)),
                        pa.array(digest[use].view(np.int64)),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(use),
                            [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(joined.tobytes())],
                        ).cast(pa.binary()),
                    ],
                    names=["doc", "version", "lo", "digest", "bytes"],
                )

    schema = "doc long, version long, lo int, digest long, bytes binary"
    found = rows.select(*COLUMNS).mapInArrow(fetch, schema)
    return found.dropDuplicates(["doc", "version", "lo", "digest"])


REPEAT = "doc long, version long, lo int, windows int"


def sorted_repeats(strings: DataFrame, length: int) -> DataFrame:
    """Repeated windows among the strings of each anchor, by the column-wise construction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush(table: pa.Table):
            doc, version, lo, back, anchor = (
                table[c].to_numpy() for c in ("doc", "version", "lo", "back", "anchor")
            )
            text, offsets = text_batch(table["bytes"])
            group = np.cumsum(np.append(0, anchor[1:] != anchor[:-1]))
            back = back.astype(np.int64)
            rank = np.empty(len(doc), dtype=np.int64)
            rank[np.lexsort((lo + back, version, doc))] = np.arange(len(doc))
            owner, first, count = column_repeats(text, offsets, back, group, rank, length)
            return pa.record_batch(
                [
                    pa.array(doc[owner]), pa.array(version[owner]),
                    pa.array((lo[owner] + first).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                names=["doc", "version", "lo", "windows"],
            )

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size > SYMBOLS:  # whole anchors only: the last one may go on
                table = pa.concat_tables(held)
                anchor = table["anchor"].to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if cut:
                    yield flush(table.slice(0, cut))
                held = [table.slice(cut)]
                size = held[0].nbytes
        if held and sum(t.num_rows for t in held):
            yield flush(pa.concat_tables(held))

    columns = ["doc", "version", "lo", "back", "anchor", "bytes"]
    placed = strings.select(*columns).repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(run, REPEAT)


STRING = "doc long, version long, lo int, back int, anchor long, digest long, bytes binary"


def cut_strings(strings: DataFrame, length: int, width: int) -> DataFrame:
    """Every string as pieces of at most `width` columns, grouped by the symbols that all share.

    Counted from the string's anchor leftwards, windows start in column 0, 1, and so on. Windows that
    start in columns b * width to (b + 1) * width - 1 all hold the `length - width + 1` symbols
    from column b * width on: with b, they are the new anchor.
    """

    def cut(batch: pa.RecordBatch):
        doc, version, lo, back, anchor = (batch.column(i).to_numpy() for i in range(5))
        text, offsets = text_batch(batch.column(5))
        back = back.astype(np.int64)
        last = back - (np.diff(offsets) - length)  # column of the last window
        low, high = last // width, back // width
        owner = np.repeat(np.arange(len(back)), high - low + 1)
        block = ragged(low, high - low + 1)
        begin = np.maximum(0, back[owner] - (block * width + width - 1))
        end = np.minimum(back[owner] - last[owner], back[owner] - block * width) + length
        at = back[owner] - block * width  # of the new anchor in the string
        up, down = Powers().to(len(text) + 1)
        start = offsets[owner]

        def code(seed: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            sums = np.append(np.uint64(0), np.cumsum(byte_codes(seed)[text] * up[: len(text)]))
            return mix((sums[start + hi] - sums[start + lo]) * down[start + lo])

        shared = code(21, at, at + length - width + 1)
        key = mix(shared + anchor[owner].view(np.uint64) * ODD + block.astype(np.uint64) * MIX_A)
        digest = code(22, begin, end) + (at - begin).astype(np.uint64) * ODD
        sizes = end - begin
        ends = np.cumsum(np.append(0, sizes)).astype(np.int64)
        joined = text[ragged(start + begin, sizes)]
        yield pa.record_batch(
            [
                pa.array(doc[owner]), pa.array(version[owner]),
                pa.array((lo[owner] + begin).astype(np.int32)),
                pa.array((at - begin).astype(np.int32)), pa.array(key.view(np.int64)),
                pa.array(mix(digest + sizes.astype(np.uint64)).view(np.int64)),
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(owner),
                    [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(joined.tobytes())],
                ).cast(pa.binary()),
            ],
            names=["doc", "version", "lo", "back", "anchor", "digest", "bytes"],
        )

    return arrow_map(strings, cut, STRING, ["doc", "version", "lo", "back", "anchor", "bytes"])


def split_groups(
    strings: DataFrame, length: int, gram: int, limit: int
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Groups of at most `limit` strings made of the larger ones in `strings`, and the repeats found."""
    place = ["doc", "version", "lo"]
    groups, found = [], []
    width = length - gram + 1
    while width > 1 and not (hot := strings.filter(F.col("n") > limit)).isEmpty():
        width = -(-width // 2)
        pieces = written(cut_strings(hot, length, width), "pieces")
        # Partial sums, then joins by place: no group meets in one task.
        distinct = pieces.groupBy("anchor", "digest").agg(F.min(F.struct(*place)).alias("first"))
        sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        firsts = written(
            distinct.join(sizes, "anchor").select("first.*", "n"), "first-pieces"
        )
        windows = (F.length("bytes") - length + 1).alias("windows")
        found.append(pieces.join(firsts, place, "left_anti").select(*place, windows))
        strings = pieces.join(firsts.filter("n > 1"), place)
        groups.append(strings.filter(F.col("n") <= limit) if width > 1 else strings)
    return groups, found


def repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, split_fragments: int = SPLIT_FRAGMENTS
) -> tuple[DataFrame, DataFrame]:
    """(doc, version, lo, windows): runs of windows that occur earlier, and the shared doc_ids (doc)."""
    rows = row_ids(docs)
    ids = rows.groupBy("doc", "key").agg(F.count(F.lit(1)).alias("n"))
    shared = written(
        ids.filter((F.col("n") > 1) | (F.col("doc") == LAST)).select("doc", "key"), "shared-ids"
    )
    several = Bitmap.of(shared, "key", 23)
    anchors = repeated_anchors(rows, length, gram)
    found = candidate_fragments(rows, several, anchors, length, gram)
    place = F.struct("doc", "version", "lo")
    same = Window.partitionBy("anchor", "digest")
    stays = F.col("anchor").isNotNull() & (F.min(place).over(same) == place)
    marked = written(
        found.withColumn("stays", stays).select(
            "doc", "version", "lo", "windows", "stays",
            *(F.when(F.col("stays"), F.col(c)).alias(c) for c in ("back", "anchor", "digest")),
        ),
        "fragments",
    )
    firsts = marked.filter("stays").select("doc", "version", "lo", "back", "anchor", "digest")
    several_of = (
        firsts.groupBy("anchor")
        .agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count("*").alias("n"))
        .filter("a < b")
        .select("anchor", "n")
    )
    strings = written(firsts.join(several_of, "anchor").distinct(), "strings")
    texts = fragment_bytes(rows, several, strings, length, gram)
    filled = strings.join(texts, ["doc", "version", "lo", "digest"])
    out = marked.filter("not stays").select("doc", "version", "lo", "windows")
    groups = [filled.filter(F.col("n") <= split_fragments)]
    if not strings.filter(F.col("n") > split_fragments).isEmpty():
        filled = written(filled, "filled")
        smaller, found = split_groups(filled, length, gram, split_fragments)
        groups = [filled.filter(F.col("n") <= split_fragments), *smaller]
        for more in found:
            out = out.unionByName(more)
    for group in groups:
        out = out.unionByName(sorted_repeats(group, length))
    return out, shared


def dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, split_fragments: int = SPLIT_FRAGMENTS,
    whole_chars: bool = False, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with what is left of its text.

    doc_id, n_bytes, kept (binary), spans: array of (start, length) in bytes of the removed runs,
    and the columns named in `keep`. `whole_chars` leaves characters that a run covers only partly.
    """
    runs, shared = repeats(docs, length, gram, split_fragments)
    # Rows without an id, or with another's, are told apart by their texts' hashes.
    shared = shared.select("doc", F.lit(True).alias("shared"))

    def part(version: str):
        return F.when(F.col("shared"), F.col(version)).otherwise(0).alias("part")

    runs = (
        runs.join(shared, "doc", "left")
        .select("doc", part("version"), "lo", "windows")
        .groupBy("doc", "part")
        .agg(F.collect_list(F.struct("lo", "windows")).alias("runs"))
    )
    extra = [F.col(c).alias(f"_{c}") for c in keep]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
        *extra,
    )
    rows = rows.withColumn("hash", F.xxhash64("text")).join(shared, "doc", "left")
    rows = rows.select("doc", part("hash"), "doc_id", "text", *(f"_{c}" for c in keep))
    joined = rows.join(runs, ["doc", "part"], "left").select(
        "doc_id", "text", "runs", *(f"_{c}" for c in keep)
    )
    schema = T._parse_datatype_string(
        "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,length:long>>"
    )
    schema = T.StructType([*schema.fields, *(joined.schema[f"_{c}"] for c in keep)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_batch(batch.column(1))
            kept, spans = [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                mine = [(r["lo"], r["windows"]) for r in found or ()]
                left, gone = cut_text(text, mine, length, whole_chars)
                kept.append(left)
                spans.append(gone)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.record_batch(
                [
                    batch.column(0), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()),
                    pa.array(spans, kind), *batch.columns[3:],
                ],
                names=["doc_id", "n_bytes", "kept", "spans", *(f"_{c}" for c in keep)],
            )

    out = joined.mapInArrow(cut, schema)
    return out.select("doc_id", "n_bytes", "kept", "spans", *(F.col(f"_{c}").alias(c) for c in keep))


def cut_text(text: np.ndarray, runs, length: int, whole_chars: bool):
    """What is left of a text, and the maximal removed runs."""
    if not runs:
        return text.tobytes(), []
    lo, windows = np.array(sorted(set(runs)), dtype=np.int64).T
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, lo + windows - 1 + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    if whole_chars:
        start = (text & 0xC0) != 0x80
        heads = np.flatnonzero(start)
        whole = np.minimum.reduceat(gone, heads)
        gone = np.repeat(whole, np.diff(np.append(heads, len(text))))
    turn = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(starts, ends)]
    return text[~gone].tobytes(), spans


def digest(docs: DataFrame) -> DataFrame:
    """How much of each text goes, and the checksum of the rest."""
    return dedup(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
