"""Packing tokenised documents into fixed-length sequences, balanced by attention cost.

A document's ids are cut into pieces: whole sequences of `capacity` ids from its start, each a
sequence of its own, and one rest. Rests are dealt into groups of bounded size; inside a group they
are taken in descending length, and each goes to the sequence of the lowest cost,

    linear * tokens + quadratic * sum of squared piece lengths,

that still has room for it. A rest that fits nowhere is cut over the cheapest open sequences. A
group has exactly as many full sequences as its ids fill; what is left over goes into sequences
whose lengths are powers of two, which need no padding. So padding is zero.

Token ids come from the `tokenizers` library; each distinct pre-token of a batch is encoded once.

Defined cases: a null or empty text has the closing id alone; a null doc_id is kept; repeated rows
are packed once per row; very long texts are many pieces; an empty table gives no pieces; columns
of other names are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.bytes_kernel import ODD, mix, powers, ragged, slices, text_batch

CAPACITY = 1024  # ids in a sequence: fixed value
END_ID = 0  # closes every document: fixed value
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
GROUP_CHARS = 1 << 24  # text of about so many characters shares a group
BATCH_BYTES = 1 << 20
CACHE_WORDS = 2_000_000  # pre-tokens a worker remembers before it starts afresh
BASE = np.uint64(0xD6E8FEB86659FD93)  # of the pre-tokens' hashes, odd
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

# Classes of characters that pre-tokens are made of.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Code points of Unicode's White_Space property, and English contractions: fixed values.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def char_classes() -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            out[point] = LETTER if kind == "L" else NUMBER
    out[WHITE_SPACE] = SPACE
    return out


def merger_of(path: str):
    """Bytes of one pre-token -> ids, where the vocabulary's ids are also its merge ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # Byte-level vocabularies write each byte as a printable character: fixed values.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if order != sorted(order) or len(set(order)) < len(order):
        return None
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in model["vocab"].items()
        if all(c in byte_of for c in token)
    }
    whole = tiktoken.Encoding("file", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return whole._encode_single_piece


class Encoder:
    """Ids of many texts at once: numpy finds the pre-tokens, and each new one is encoded once.

    Built for byte-level BPE whose pre-tokens are contractions, runs of letters, numbers or other
    characters with one space before them, and white space. Where the file's merges stand in the
    order of their ids, single pre-tokens are merged by tiktoken from the same vocabulary, which
    gives the same ids several times faster; else the tokenizer encodes them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merger = merger_of(path)
        self.classes = char_classes()
        with np.errstate(over="ignore"):
            self.codes = mix(np.arange(1, sys.maxunicode + 2, dtype=np.uint64) * ODD)
        self.powers, self.inverse = powers(BASE, 0), powers(BASE_INVERSE, 0)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts that hold a special token's string are left to the tokenizer itself.
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.forget()

    def forget(self) -> None:
        """Known pre-tokens: sorted keys, the place of each, and per place its ids in the pool."""
        self.keys = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(1, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start (one entry more)."""
        text = "".join(texts)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        bounds = np.cumsum([0, *map(len, texts)])
        starts = self.word_starts(points, bounds)
        ids, counts = self.word_ids(text, points, starts)
        upto = np.concatenate([[0], np.cumsum(counts)])
        return ids, upto[np.searchsorted(starts, bounds)]

    def word_starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(points)
        if not n:
            return np.zeros(0, dtype=np.int64)
        kind = self.classes[points]
        first = np.zeros(n + 1, dtype=bool)  # starts of texts, and the end
        first[bounds] = True
        new = np.empty(n, dtype=bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        new |= first[:n]
        space = kind == SPACE
        # The last white space before other characters is not part of the run before it ...
        last = space & np.append(~space[1:], True) & ~first[1:]
        # ... and a plain space there opens the next word.
        joined = last & (points == 32)
        start = new | last
        start[1:][joined[:-1]] = False
        start |= first[:n]
        self._contractions(points, kind, first, joined, start)
        return np.flatnonzero(start)

    @staticmethod
    def _contractions(points, kind, first, joined, start) -> None:
        n = len(points)
        for at in np.flatnonzero((points == 39) & start).tolist():
            if at + 1 >= n or first[at + 1]:
                continue
            after = "".join(map(chr, points[at + 1 : at + 3].tolist()))
            if at + 2 < n and first[at + 2]:
                after = after[:1]
            tail = next((c for c in CONTRACTIONS if after.startswith(c)), None)
            if tail and kind[at + 1] == LETTER:
                stop = at + 1 + len(tail)
                start[at + 1 : stop] = False
                if stop < n and kind[stop] == LETTER:
                    start[stop] = True

    def word_ids(self, text, points, starts) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(starts), len(points)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        if size > len(self.powers):
            self.powers, self.inverse = powers(BASE, size), powers(BASE_INVERSE, size)
        sums = np.add.reduceat(self.codes[points] * self.powers[:size], starts)
        sizes = np.diff(np.append(starts, size))
        hashes = mix(sums * self.inverse[starts] + sizes.astype(np.uint64))
        group, unique = pd.factorize(hashes)
        firsts = np.empty(len(unique), dtype=np.int64)
        firsts[group[::-1]] = np.arange(n - 1, -1, -1)
        if len(self.keys) > CACHE_WORDS:
            self.forget()
        at = np.minimum(np.searchsorted(self.keys, unique), max(0, len(self.keys) - 1))
        found = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), dtype=bool)
        place = np.empty(len(unique), dtype=np.int64)
        place[found] = self.places[at[found]]
        fresh = np.flatnonzero(~found)
        if len(fresh):
            lo = starts[firsts[fresh]]
            hi = (lo + sizes[firsts[fresh]]).tolist()
            place[fresh] = self.learn([text[a:b] for a, b in zip(lo.tolist(), hi)])
            order = np.argsort(unique[fresh])
            new, where = unique[fresh][order], place[fresh][order]
            slot = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, slot, new)
            self.places = np.insert(self.places, slot, where)
        place = place[group]
        lengths = self.starts[place + 1] - self.starts[place]
        return self.pool[ragged(self.starts[place], lengths)], lengths

    def learn(self, words: list[str]) -> np.ndarray:
        """Encode pre-tokens and add their ids to the pool; their places."""
        if self.merger:
            merge, utf8 = self.merger, [w.encode() for w in words]
            encoded = [merge(w) for w in utf8]
        else:
            batch = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            encoded = [e.ids for e in batch]
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        new = np.fromiter(chain.from_iterable(encoded), dtype=np.int32, count=int(lengths.sum()))
        first = len(self.starts) - 1
        self.pool = np.concatenate([self.pool, new])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return np.arange(first, first + len(words))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        special = self.special
        odd = {i for i, t in enumerate(texts) if special and special.search(t)}
        ids, bounds = self.encode(["" if i in odd else t for i, t in enumerate(texts)])
        out = [ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        for i in odd:
            out[i] = np.array(
                self.tokenizer.encode(texts[i], add_special_tokens=False).ids, dtype=np.int32
            )
        return out


class Rooms:
    """Open sequences as (cost, number), a heap for each room, under a tree of the least entries."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity - 1).bit_length()
        self.heaps = [[] for _ in range(capacity + 1)]
        self.least = [None] * (2 * self.leaves)

    def add(self, room: int, entry: tuple[float, int]) -> None:
        heapq.heappush(self.heaps[room], entry)
        self._renew(room)

    def take(self, room: int) -> None:
        heapq.heappop(self.heaps[room])
        self._renew(room)

    def _renew(self, room: int) -> None:
        at, heap = self.leaves + room - 1, self.heaps[room]
        least = heap[0] if heap else None
        while at and self.least[at] != least:
            self.least[at] = least
            a, b = least, self.least[at ^ 1]
            least = b if a is None else a if b is None else min(a, b)
            at >>= 1

    def cheapest(self, room: int) -> tuple[float, int] | None:
        """The least (cost, number) among all with at least so much room."""
        at = self.leaves + room - 1
        found = self.least[at]
        while at > 1:
            if not at & 1 and (other := self.least[at + 1]) is not None:
                found = other if found is None else min(found, other)
            at >>= 1
        return found


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(item, start in item, length, sequence, offset) of items packed without padding.

    Items are shorter than `capacity`. The first sequences are full; the last ones hold powers of
    two. Items go by falling length to the cheapest of all sequences with room for the whole item;
    only where none has, the item is cut, and its start fills the cheapest one.
    """
    total = int(lengths.sum())
    room = [capacity] * (total // capacity)
    rest = total % capacity
    room += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    limit = list(room)
    open_by_room = Rooms(capacity)
    for s, free in enumerate(room):
        open_by_room.add(free, (0.0, s))
    out = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        left, start = int(lengths[item]), 0
        while left:
            cost, s = open_by_room.cheapest(left) or open_by_room.cheapest(1)
            open_by_room.take(room[s])
            size = min(left, room[s])
            out.append((item, start, size, s, limit[s] - room[s]))
            room[s] -= size
            if room[s]:
                dearer = cost + LINEAR * size + QUADRATIC * size * size
                open_by_room.add(room[s], (dearer, s))
            start, left = start + size, left - size
    return out


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids binary"
)
CUT = "doc_id long, start long, doc_tokens long, length long, group long, crc long, ids binary"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_documents(docs: DataFrame, tokenizer_path: str, groups: int, with_ids: bool) -> DataFrame:
    """Whole sequences and rests of every document; a rest carries its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_path)
            _, offsets = text_batch(batch.column(1))
            for lo, hi in slices(offsets, BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield _cut_rows(
                    part.column(0).to_pylist(), part.column(2).to_numpy(),
                    encoder.encode_all(texts), with_ids,
                )

    key = F.xxhash64("doc_id", F.length("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.pmod(key, F.lit(groups)).alias("group"),
    )
    return rows.mapInArrow(cut, CUT)


def _cut_rows(doc_ids, groups, encoded, with_ids) -> pa.RecordBatch:
    rows = []
    for doc_id, group, ids in zip(doc_ids, groups.tolist(), encoded):
        ids = np.append(ids, END_ID)
        for start in range(0, len(ids), CAPACITY):
            piece = ids[start : start + CAPACITY]
            keep = with_ids or len(piece) < CAPACITY
            rows.append(
                (doc_id, start, len(ids), len(piece), group, crc(piece),
                 piece.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes() if keep else None)
            )
    names = ["doc_id", "start", "doc_tokens", "length", "group", "crc", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    columns = zip(*rows) if rows else [[]] * 7
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def widened(ids: bytes, size: int) -> np.ndarray:
    """Ids as uint32; they travel as uint16 where that holds them."""
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * size else "<u4").astype("<u4")


def pack_group(part: pa.Table) -> pa.Table:
    """Sequences of one group, numbered within it; ids of pieces are kept where they are there."""
    part = part.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("crc", "ascending")])
    base = part["group"][0].as_py() << 32
    lengths = part["length"].to_numpy()
    whole = lengths == CAPACITY
    full, rest = part.filter(pa.array(whole)), part.filter(pa.array(~whole))
    n = len(full)
    columns = {
        "doc_id": full["doc_id"].to_pylist(), "start": full["start"].to_pylist(),
        "length": full["length"].to_pylist(), "ids_crc32": full["crc"].to_pylist(),
        "doc_tokens": full["doc_tokens"].to_pylist(),
        "sequence_id": list(range(base, base + n)), "offset": [0] * n,
        "ids": [x and widened(x, CAPACITY).tobytes() for x in full["ids"].to_pylist()],
    }
    doc_ids, starts = rest["doc_id"].to_pylist(), rest["start"].to_pylist()
    tokens, ids, sizes = rest["doc_tokens"].to_pylist(), rest["ids"].to_pylist(), lengths[~whole]
    for item, start, size, sequence, offset in pack(sizes):
        piece = widened(ids[item], sizes[item])[start : start + size]
        for name, value in zip(
            columns,
            (doc_ids[item], starts[item] + start, size, zlib.crc32(piece.tobytes()),
             tokens[item], base + n + sequence, offset, piece.tobytes()),
        ):
            columns[name].append(value)
    kinds = [pa.int64()] * 7 + [pa.binary()]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), kinds)})


def pack_documents(docs: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places in sequences; `ids` as little-endian uint32.

    Without `with_ids`, whole sequences have no ids (their checksum is there), which spares the
    shuffle most of its bytes.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, chars // GROUP_CHARS)
    cut = cut_documents(docs, tokenizer_path, groups, with_ids)
    return cut.groupBy("group").applyInArrow(pack_group, PIECE)


def digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path, with_ids=False).drop("ids")
