import hashlib
import random

import pytest

from casemart.llm import simhash


def test_edited_texts_and_equal_prints(messy, texts):
    out = simhash.digest(messy).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    plain = [(i, t or "") for i, t in texts if i is not None and i < 111]
    rows = sorted(plain, reverse=True)
    for (i, t), (_, after) in zip(rows, rows[1:]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        (got,) = by_id[i]
        assert got.n_chars == len(t)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got.near_edited <= 1 and 0 <= got.near_next <= 1
    prints = {}
    for i, t in plain:
        prints.setdefault(t, set()).add(by_id[i][0].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_votes_match_a_plain_count(spark):
    text = " ".join(random.Random(2).choices(["alpha", "be", "gammas", "d", "epsilon"], k=20_000))
    frame = spark.createDataFrame([(1, text)], "id long, text string")
    (got,) = simhash.fingerprints(frame, ["id"]).collect()
    hashes = {
        r.w: r.h for r in spark.createDataFrame([(w,) for w in set(text.split())], "w string")
        .selectExpr("w", "xxhash64(w) h").collect()
    }
    votes = [0] * 64
    for w in text.split():
        weight = min(8, max(1, len(w) - 2))
        for bit in range(64):
            votes[bit] += weight if hashes[w] >> bit & 1 else -weight
    assert got.fingerprint & (2**64 - 1) == sum(1 << b for b in range(64) if votes[b] > 0)


@pytest.mark.parametrize("times", [3000, 4095, 4096, 8000, 100_000])
def test_one_heavy_word_repeated(spark, times):
    """All votes of a chunk go to the same bits, the highest counters and the sign's among them."""
    words = [f"heavyword{i:02d}" for i in range(24)]
    frame = spark.createDataFrame([(w, f"{w} " * times) for w in words], "w string, text string")
    got = {r.w: r.fingerprint for r in simhash.fingerprints(frame, ["w"]).collect()}
    want = {r.w: r.h for r in frame.selectExpr("w", "xxhash64(w) h").collect()}
    assert got == want


def test_next_and_near_against_plain_counts(spark, messy):
    """Shared and null ids included: the next row is a row, and near rows are counted one by one."""
    out = simhash.digest(messy).collect()
    mask = (1 << 64) - 1
    prints = [int(r.fingerprint, 16) & mask for r in out]
    for r, p in zip(out, prints):
        if r.doc_id is not None and r.doc_id % 20 == 0:
            assert r.n_near == sum((p ^ q).bit_count() <= 3 for q in prints) - 1
        else:
            assert r.n_near is None
    texts = sorted(
        ((i, t or "") for i, t in messy.select("doc_id", "text").collect()),
        key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest()),
    )
    by_text = {}
    for r in simhash.fingerprints(messy, ["text"]).collect():
        by_text[r.text or ""] = r.fingerprint & mask
    want = sorted(
        (str(i), len(t), 1 - (by_text[t] ^ by_text[texts[(n + 1) % len(texts)][1]]).bit_count() / 64)
        for n, (i, t) in enumerate(texts)
    )
    assert sorted((str(r.doc_id), r.n_chars, r.near_next) for r in out) == want


def test_repeated_rows_stay_apart(spark):
    long_text = " ".join(f"word{i:09d}" for i in range(8000))  # fills the counters of one row
    rows = [(1, "same words here")] * 5 + [(2, long_text)] * 4 + [(3, long_text)]
    rows += [(None, "no id at all")] * 4 + [(None, long_text)] * 3 + [(None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = simhash.digest(frame).collect()
    got = sorted((r.doc_id or 0, r.n_chars) for r in out)
    assert got == sorted((i or 0, len(t or "")) for i, t in rows)
    prints = {}
    for r in out:
        prints.setdefault(r.n_chars, set()).add(r.fingerprint)
    single = simhash.fingerprints(
        spark.createDataFrame([(1, long_text)], "id long, text string"), ["id"]
    ).first().fingerprint
    assert prints[len(long_text)] == {f"{single & (2**64 - 1):016x}"}
    assert all(len(p) == 1 for p in prints.values())


def test_radius_search_finds_all_pairs(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(80)]
    for v in values[:40]:
        for flips in (1, 2, 3, 4):
            for b in rng.sample(range(64), flips):
                v ^= 1 << b
            values.append(v)
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {(r.query, r.found, r.distance) for r in simhash.within_radius(frame, frame).collect()}
    mask = (1 << 64) - 1
    want = {
        (a, b, n) for a in signed for b in signed
        if a != b and (n := ((a ^ b) & mask).bit_count()) <= 3
    }
    assert got == want and want


def test_empty_table_and_plan(no_docs, messy, plan):
    assert simhash.digest(no_docs).count() == 0
    assert "Python" not in plan(simhash.fingerprints(messy, ["doc_id"]))
