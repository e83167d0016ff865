import numpy as np
import pytest

from casemart.llm import mixing


def reference_targets(sizes, weights, share, cap):
    """Reshare what the caps leave over, by weight, until no source is above its cap."""
    total, fixed = share * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        part = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if part[i] > cap * sizes[i]]
        if not over:
            return [fixed.get(i, part.get(i)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 1000, 12).tolist()
    weights = [(3.0, 1.0, 2.0)[i % 3] for i in range(12)]
    got = mixing.water_fill(sizes, weights, 1.5 * sum(sizes), 0.0, 2.0)
    assert got == pytest.approx(reference_targets(sizes, weights, 1.5, 2.0))
    kept = mixing.water_fill(sizes, weights, 1.5 * sum(sizes), 1.0, 2.0)
    assert sum(kept) == pytest.approx(1.5 * sum(sizes))
    assert all(s <= t + 1e-9 <= 2 * s + 1e-6 for s, t in zip(sizes, kept))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    got = mixing.permuted(np.arange(n), n, 99)
    assert sorted(got.tolist()) == list(range(n))


def test_digest(messy, texts):
    out = mixing.digest(messy)
    rows = sorted((r.doc_id or -1, r["size"], r.taken) for r in out.collect())
    assert rows == sorted((r.doc_id or -1, r["size"], r.taken) for r in out.collect())
    assert len(rows) == len(texts)
    import re
    sizes = sorted((i or -1, len(re.findall(mixing.WORD, t or ""))) for i, t in texts)
    assert [(i, s) for i, s, _ in rows] == sizes
    assert all(0 <= t <= 2 * s for _, s, t in rows)
    for (_, target), g in out.toPandas().groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - target) <= 64


def test_many_shards_reach_the_same_counts(messy):
    sizes = mixing.sized(messy)
    for shard_slots in (7, 1 << 14):
        pieces, sources = mixing.mix(sizes, block_words=16, shard_slots=shard_slots)
        got = {r.source_index: r.n for r in pieces.select("source_index", "shard", "slot")
               .distinct().groupBy("source_index").count().withColumnRenamed("count", "n")
               .collect()}
        assert got == {s.index: s.slots for s in sources if s.slots}


def test_missing_slots_are_dealt_over_all_shards(spark):
    runs = mixing.dealt(spark, [(0, 5, 12), (3, 0, 2), (4, 100, 1130)], 10).collect()
    for source, first, last in [(0, 5, 12), (3, 0, 2), (4, 100, 1130)]:
        mine = sorted((r["first"], r["last"]) for r in runs if r.source_index == source)
        assert [k for a, b in mine for k in range(a, b)] == list(range(first, last))
        sizes = [b - a for a, b in mine]
        assert max(sizes) - min(sizes) <= 1
        assert len({r.shard for r in runs if r.source_index == source}) == min(10, last - first)


def test_mixed_texts(messy, texts):
    docs = messy.filter("doc_id < 100")
    out = mixing.mixed_texts(docs, block_words=8)
    assert out.columns == docs.columns
    wanted = {i: t for i, t in texts if i is not None and i < 100}
    found = {}
    for r in out.collect():
        found.setdefault(r.doc_id, []).append(r.text)
    assert set(found) == set(wanted)
    assert all(wanted[i] in ts and len(ts) <= 2 for i, ts in found.items())
    for i, ts in found.items():
        for t in ts:
            assert all(w in wanted[i] for w in t.split())


def test_empty(no_docs):
    assert mixing.digest(no_docs).count() == 0
    assert mixing.mixed_texts(no_docs).count() == 0
