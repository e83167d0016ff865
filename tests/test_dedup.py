from collections import Counter

import pytest
from pyspark.sql import functions as F

from casemart.operators import dedup_by_priority, duplicate_audit, step_counts


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key; the rest are unique or pairs."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.col("id").cast("string"))
        .otherwise((F.col("id") - F.col("id") % 2).cast("string"))
        .alias("k"),
        (F.col("id") * 7919 % 1000).alias("v"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 11).alias("w"),
    )


def best_rows(frame, priority):
    best = {}
    for r in frame.collect():
        if r.k not in best or priority(r) < priority(best[r.k]):
            best[r.k] = r
    return sorted(tuple(r) for r in best.values())


def test_matches_brute_force_with_a_hot_key(hot, rows):
    out = dedup_by_priority(hot, "k", [F.col("v").desc()])
    null_first = lambda x: (x is not None, x or 0)
    want = best_rows(hot, lambda r: (-r.v, null_first(r.w)))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)


def test_group_limit_runs_before_the_shuffle(hot, plan):
    text = plan(dedup_by_priority(hot, "k", [F.col("v").desc()]))
    final, partial = text.index("Exchange hashpartitioning"), text.rindex("WindowGroupLimit")
    assert text.count("WindowGroupLimit") == 2 and final < partial


def test_null_keys_collapse_to_one_row(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    out = dedup_by_priority(frame, "k", [F.col("v").asc()])
    assert sorted(r.v for r in out.collect()) == [1, 3]


def test_tie_breakers_make_the_survivor_stable(spark):
    data = [("a", "x", i) for i in range(50)]
    picked = set()
    for n in (1, 3, 8):
        frame = spark.createDataFrame(data[::-1] if n == 3 else data, "k string, p string, v int")
        frame = frame.repartition(n, "v")
        picked.add(dedup_by_priority(frame, "k", [F.col("p").asc()]).first().v)
    assert picked == {0}


def test_duplicate_audit_matches_brute_force(hot):
    groups = {}
    for r in hot.collect():
        groups.setdefault(r.k, []).append(r)
    want = {
        k: (len(g), ",".join(c for c in ("v", "w") if len({r[c] for r in g}) > 1))
        for k, g in groups.items()
        if len(g) > 1
    }
    got = {r.k: (r.n_rows, r.differing_columns) for r in duplicate_audit(hot, "k").collect()}
    assert got == want


def test_duplicate_audit_sees_null_against_value(spark):
    frame = spark.createDataFrame(
        [("a", "x", None, 1), ("a", None, None, 1), ("b", "y", "z", 2)],
        "k string, p string, q string, r int",
    )
    assert [tuple(r) for r in duplicate_audit(frame, "k").collect()] == [("a", 2, "p")]


def test_duplicate_audit_matches_null_keys(spark):
    frame = spark.createDataFrame(
        [(None, "a", 1), (None, "a", 2), ("x", None, 3), ("x", None, 3), ("x", "b", 4)],
        "k string, l string, v int",
    )
    got = {(r.k, r.l): (r.n_rows, r.differing_columns) for r in duplicate_audit(frame, ["k", "l"]).collect()}
    assert got == {(None, "a"): (2, "v"), ("x", None): (2, "")}


def test_duplicate_audit_splits_a_hot_key(spark, hot, plan, shuffled_joins):
    """Shuffled join, hot key: AQE splits its partition and the rows are folded before the
    last shuffle."""
    out = duplicate_audit(hot.repartition(16), "k")
    n = {r.k: r.n_rows for r in out.collect()}
    text = plan(out).split("== Initial Plan ==")[0]
    assert n["hot"] == 10_000
    assert "skew=true" in text and "partial_count" in text


def test_step_counts(hot):
    keys = Counter(r.k for r in hot.collect())
    got = step_counts(hot, "k").first()
    assert tuple(got) == (30_000, len(keys), sum(n > 1 for n in keys.values()))
    empty = step_counts(hot.filter("false"), "k").first()
    assert tuple(empty) == (0, 0, 0)
