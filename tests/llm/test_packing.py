import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from casemart.llm import packing
from casemart.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer, encoder):
    rng = random.Random(3)
    parts = ["a", "b", "'s", "'t", "'ll", "'re", "'", " ", "  ", "\n", "\t", "é", "ß", "1", "23",
             "!", "...", "<", "漢", "'ve", "'m", "'d", "\x1c", "😀", "İ", "\r\n", "it", "X",
             "<|endoftext|>", "z" * 70]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(4000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode_all(texts)] == want
    # The way without merge ranks, and with a cache that is forgotten, gives the same.
    encoder.merger, merger = None, encoder.merger
    encoder.forget()
    assert [ids.tolist() for ids in encoder.encode_all(texts[:300])] == want[:300]
    encoder.merger = merger


@pytest.mark.parametrize("seed", range(4))
def test_pack_without_padding(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 1024, rng.integers(1, 400))
    cover = defaultdict(list)
    fill = defaultdict(list)
    for item, start, size, sequence, offset in packing.pack(lengths):
        cover[item].append((start, size))
        fill[sequence].append((offset, size))
    for item, n in enumerate(lengths):
        at = 0
        for start, size in sorted(cover[item]):
            assert start == at
            at += size
        assert at == n
    for pieces in fill.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 1024 and at & (at - 1) == 0


def test_every_id_in_one_piece(messy, texts, tokenizer):
    out = packing.pack_documents(messy, tokenizer_path()).collect()
    rest = defaultdict(list)
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        rest[i].append(np.array(ids, dtype="<u4"))
    pieces = defaultdict(list)
    for r in out:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.doc_tokens, ids))
    assert set(pieces) == set(rest)
    for i, want in rest.items():
        assert sum(len(x[2]) for x in pieces[i]) == sum(map(len, want))
        if len(want) == 1:
            joined = np.concatenate([x[2] for x in sorted(pieces[i], key=lambda x: x[0])])
            assert (joined == want[0]).all() and {x[1] for x in pieces[i]} == {len(joined)}
    total = defaultdict(int)
    for r in out:
        total[r.sequence_id] += r.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in total.values())


def test_empty(no_docs):
    assert packing.digest(no_docs, tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_an_item_is_cut_only_where_none_has_room(seed):
    """Each whole item goes to the cheapest of all sequences with room, looked up one by one."""
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5, 1.1, 800).astype(int), 1, 1023)
    placed = packing.pack(lengths)
    total, size = int(lengths.sum()), packing.CAPACITY
    room = [size] * (total // size)
    room += [1 << b for b in range((total % size).bit_length() - 1, -1, -1) if total % size >> b & 1]
    cost = [0.0] * len(room)
    whole = 0
    for item, start, length, s, _ in placed:
        left = int(lengths[item]) - start
        able = [t for t in range(len(room)) if room[t] >= left]
        if able:
            assert length == left and s == min(able, key=lambda t: (cost[t], t))
            whole += start == 0
        else:
            assert length == room[s] < left
        room[s] -= length
        cost[s] += packing.LINEAR * length + packing.QUADRATIC * length * length
    assert not any(room) and whole > 0.8 * len(lengths)
