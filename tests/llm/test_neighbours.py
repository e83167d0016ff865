import numpy as np

from casemart.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, dim string, block string"


def rows():
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    data += [(300 + i, data[3][1]) for i in range(120)]  # many equal vectors
    data += [(420 + i, (10.0 ** (i - 6) * rng.normal(size=8)).tolist()) for i in range(20)]
    data += [(440, None), (460, []), (480, [0.0] * 8), (500, [1.0, None] + [0.0] * 6),
             (520, [float("nan")] + [1.0] * 7), (540, [float("inf")] + [1.0] * 7),
             (560, [1.0, 2.0]), (561, [3.0, 1.0]), (None, [1.0] * 8), (20, data[20][1])]
    return data


def test_exact(spark):
    data = rows()
    frame = spark.createDataFrame([(i, v, 0, "d", "b") for i, v in data], SCHEMA)
    got = {}
    for r in neighbours.nearest(
        frame, frame.filter("vec_id % 20 = 0"), 20, query_rows=7, block_rows=50
    ).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {
        i: np.array(v, dtype=np.float32).astype(float) for i, v in data
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    want = {}
    for q in (i for i in good if i % 20 == 0):
        near = sorted(
            (-float((good[q] * v).sum()), i) for i, v in good.items()
            if i != q and len(v) == len(good[q])
        )[:20]
        want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(near)]
    assert set(got) == set(want)
    for q, near in want.items():
        mine = sorted(got[q])
        assert [x[:2] for x in mine] == [x[:2] for x in near]
        np.testing.assert_allclose([x[2] for x in mine], [x[2] for x in near], rtol=1e-12)


def test_empty(spark):
    assert neighbours.digest(spark.createDataFrame([], SCHEMA)).count() == 0
