import hashlib

import numpy as np
import pytest

from casemart.llm import suffixes


def brute(rows, length):
    """rows: (order, text bytes); what each keeps, and its removed runs."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        cover = np.zeros(len(text) + 1, dtype=int)
        for i in range(len(text) - length + 1):
            w = text[i : i + length]
            if w in seen:
                cover[i : i + length] = 1
            seen.add(w)
        gone = cover[:-1] > 0
        kept = bytes(b for b, g in zip(text, gone) if not g)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[key] = (len(text), int(gone.sum()), int((edges == 1).sum()),
                    hashlib.sha256(kept).hexdigest())
    return out


def digest(out):
    return {
        r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans),
                   hashlib.sha256(r.kept).hexdigest())
        for r in out.collect()
    }


@pytest.mark.parametrize("length,gram,hot", [(100, 40, 20_000), (100, 40, 1), (20, 8, 20_000)])
def test_same_as_brute_force(messy, texts, length, gram, hot):
    frame = messy.filter("doc_id < 111")
    rows = [(i, (t or "").encode()) for i, t in texts if i is not None and i < 111]
    got = digest(suffixes.dedup(frame, length, gram, hot))
    assert got == brute(rows, length)
    assert sum(x[1] for x in got.values()) > 1000


def test_shared_ids_and_rows_without_one(messy, spark):
    out = suffixes.dedup(messy).collect()
    assert len(out) == messy.count()
    same_id = [r for r in out if r.doc_id == 111]
    assert sorted(len(r.spans) for r in same_id) == [0, 1]  # one text repeats within itself
    again = [r for r in out if r.doc_id == 112]
    assert all(r.kept == b"repeated row" for r in again)


def test_whole_chars_and_other_columns(spark):
    line = "é漢😀ß" * 30
    rows = [(1, line, "a"), (2, "x" + line + "y", "b"), (3, "é" * 49 + "x", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    out = {r.doc_id: r for r in suffixes.dedup(frame, whole_chars=True, keep=("key",)).collect()}
    assert {i: r.key for i, r in out.items()} == {1: "a", 2: "b", 3: "c"}
    for r in out.values():
        r.kept.decode()  # whole characters
    assert out[2].kept.decode() == "xy" and out[3].kept.decode() == rows[2][1]


def test_columns_against_sorted_suffixes():
    """The column-wise order finds what comparing all windows finds, in random small alphabets."""
    rng = np.random.default_rng(8)
    for _ in range(20):
        length, strings, back, group, rank = 6, [], [], [], []
        for g in range(4):
            anchor = bytes(rng.integers(97, 99, 3).tolist())
            for _ in range(rng.integers(1, 7)):
                b = int(rng.integers(0, 5))
                left = bytes(rng.integers(97, 99, b).tolist())
                right = bytes(rng.integers(97, 99, rng.integers(4, 9)).tolist())
                strings.append(left + anchor + right)
                back.append(b)
                group.append(g)
        rank = rng.permutation(len(strings))
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        offsets = np.cumsum([0, *map(len, strings)])
        owner, first, count = suffixes.column_repeats(
            data, offsets, np.array(back), np.array(group), rank, length
        )
        got = {(o, f + i) for o, f, n in zip(owner, first, count) for i in range(n)}
        best = {}
        windows = [(i, p) for i, s in enumerate(strings) for p in range(len(s) - length + 1)]
        for i, p in windows:
            k = (group[i], p - back[i], strings[i][p : p + length])
            best[k] = min(best.get(k, 10**9), rank[i])
        want = {(i, p) for i, p in windows
                if best[(group[i], p - back[i], strings[i][p : p + length])] != rank[i]}
        assert got == want


@pytest.mark.parametrize("shared", [45, 70, 95, 140])
def test_one_passage_in_all_texts(spark, shared):
    """An anchor with far more strings than a task sorts is cut into smaller groups, exactly."""
    rng = np.random.default_rng(shared)

    def text(n):
        return "".join(rng.choice(list("abcd"), n))

    passage, heads, tails = text(shared), [text(40) for _ in range(9)], [text(60) for _ in range(9)]
    rows = [
        (i, text(30) + heads[rng.integers(9)] + passage + tails[rng.integers(9)] + text(50))
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute([(i, t.encode()) for i, t in rows], 100)
    for limit in (3, 50):
        assert digest(suffixes.dedup(frame, split_fragments=limit)) == want
    assert sum(x[1] for x in want.values()) > 1000


def test_pieces_hold_each_window_once(spark):
    rng = np.random.default_rng(1)
    length, gram, width = 100, 40, 61
    rows = []
    for i in range(50):
        back, more = int(rng.integers(0, 61)), int(rng.integers(0, 61))
        size = length + min(back, more)
        rows.append((i, 0, 1000, back, 7, bytes(rng.integers(97, 123, size).tolist())))
    frame = spark.createDataFrame(
        rows, "doc long, version long, lo int, back int, anchor long, bytes binary")
    whole = {r[0]: r[5] for r in rows}
    for width in (31, 8, 1):
        windows = []
        for p in suffixes.cut_strings(frame, length, width).collect():
            assert bytes(p.bytes) == whole[p.doc][p.lo - 1000 :][: len(p.bytes)]
            assert len(p.bytes) < length + width and 0 <= p.back < width
            windows += [(p.doc, p.lo - 1000 + w) for w in range(len(p.bytes) - length + 1)]
        want = [(i, w) for i, b in whole.items() for w in range(len(b) - length + 1)]
        assert sorted(windows) == want


def test_a_task_remembers_smaller_places():
    seen = suffixes.Seen(4)
    key, digest = np.array([5, 6], dtype=np.uint64), np.array([1, 1], dtype=np.uint64)
    at = lambda *v: np.array(v, dtype=np.int64)
    assert seen.later(key, digest, at(9, 9), at(0, 0), at(3, 3)).tolist() == [False, False]
    assert seen.later(key[:1], digest[:1], at(9), at(0), at(4)).tolist() in ([True], [False])
    one = suffixes.Seen(4)
    one.later(key[:1], digest[:1], at(9), at(0), at(3))
    assert one.later(key[:1], digest[:1], at(9), at(0), at(3)).tolist() == [False]  # itself
    assert one.later(key[:1], digest[:1], at(9), at(0), at(4)).tolist() == [True]
    assert one.later(key[:1], digest[:1], at(2), at(7), at(9)).tolist() == [False]
    assert one.later(key[:1], digest[:1], at(9), at(0), at(3)).tolist() == [True]


def test_empty(no_docs):
    assert suffixes.digest(no_docs).count() == 0
