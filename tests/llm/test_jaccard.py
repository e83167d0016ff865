import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemart.llm import jaccard
from casemart.llm.components import components

FOLD = {i: i + 32 for i in range(65, 91)}


def brute(texts, n, num, den):
    sets = []
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets.append((i, {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, len(s), least.get(find(a)), links[a]) for a, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("n,num,den,block", [(4, 85, 100, 1024), (4, 85, 100, 2), (5, 80, 100, 3),
                                             (2, 50, 100, 1024)])
def test_same_as_all_pairs(messy, texts, n, num, den, block, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    # Rows without an id are compared too, and an id given twice is one node: left to their own test.
    frame = messy.filter("doc_id is not null and doc_id <> 111")
    rows = [(i, t) for i, t in texts if i is not None and i != 111]
    got = sorted(map(tuple, jaccard.join(frame, n, num, den).collect()))
    assert got == sorted(brute(rows, n, num, den))
    assert max(x[3] for x in got) > 5


def test_rows_without_an_id(messy):
    out = [r for r in jaccard.join(messy).collect() if r.doc_id is None]
    assert len(out) == 2 and any(r.n_shingles > 50 for r in out)


def test_empty(no_docs):
    assert jaccard.digest(no_docs).count() == 0


def test_a_tile_in_several_column_chunks():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64)) for _ in range(60)]
    sets += [s[: len(s) * 9 // 10] for s in sets[:20]]
    links, root = jaccard.compare_tile(sets, list(range(80)), [0] * 80, [1] * 80, PLAIN)
    want = [sum(100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets) - 1
            for a in sets]
    assert links.tolist() == want and (root[60:] == np.arange(20)).all()


# Thresholds alone, where tokens are in their order already.
PLAIN = jaccard.Order(4, 85, 100, np.uint64(0), [])


def test_group_pairs_hold_every_link_and_few_others():
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 40, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(base, rng.integers(20, 400), replace=False)) for _ in range(80)]
    sets += [np.unique(np.append(rng.choice(s, len(s) - k % 9, replace=False), base[:2]))
             for k, s in enumerate(sets)]
    pairs = jaccard.group_pairs(sets, PLAIN)
    linked = np.array([[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets]
                       for a in sets])
    assert (pairs | ~linked).all() and linked.sum() > 200 and (pairs == pairs.T).all()
    assert pairs.sum() < pairs.size / 5


def test_lists_in_several_chunks(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 30, 60)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n = rng.integers(90, 110, sizes.sum())
    rest = n - rng.integers(0, 12, sizes.sum())
    want = [tuple(np.concatenate(x)) for x in zip(*jaccard.list_pairs(starts, n, rest, PLAIN))]
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 50)
    got = [tuple(np.concatenate(x)) for x in zip(*jaccard.list_pairs(starts, n, rest, PLAIN))]
    assert got == want and len(got[0]) > 100
    place = np.searchsorted(starts, got, "right")
    assert (place[0] == place[1]).all()


def test_a_passage_in_a_third_of_the_texts_makes_few_pairs(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = []
    for i in range(3000):
        own = [f"w{rng.randrange(10**7)}" for _ in range(rng.randint(15, 25))]
        texts.append((i, " ".join(own[:8]) + (f" {passage} " if i % 3 == 0 else " x ") + " ".join(own[8:])))
    texts += [(3000 + i, texts[i][1]) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    order = jaccard.order_of(docs, 4, 85, 100)
    sets = jaccard.prefixes(docs, order).dropDuplicates(["d1", "d2"]).withColumn(
        "copies", F.lit(1)).withColumn("rep", F.col("doc_id"))
    sizes = [r[0] for r in jaccard.clusters_of(sets, order).groupBy("cluster").count()
             .select("count").collect()]
    assert sum(k * k for k in sizes) < 1000**2 / 25  # of the thousand that share the passage
    got = sorted(map(tuple, jaccard.digest(docs).collect()))
    assert got == sorted((i, len(t.split()) - 3, i % 3000, int(i % 3000 < 5)) for i, t in texts)


def test_components_of_long_paths_and_stars(spark):
    rng = np.random.default_rng(3)
    names = rng.permutation(400)
    edges = [(int(names[i]), int(names[i + 1])) for i in range(199)]
    edges += [(int(names[399]), int(names[i])) for i in range(200, 390)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    path, star = set(names[:200].tolist()), {*names[200:390].tolist(), int(names[399])}
    assert got == {n: min(path) for n in path} | {n: min(star) for n in star}
